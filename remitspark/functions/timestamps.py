"""Zone-less timestamps in four text shapes.

The result never depends on the session time zone: the digits go straight into a
``timestamp_ntz`` and do not pass through a zoned timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from remitspark.functions.text import clean

YEAR = "((?!0000)[0-9]{4})"
NUM = "([0-9]{1,2})"
DAY = "( [0-9]|[0-9]{1,2})"  # one padding space may stand for the leading zero
MINUTE = "([0-9]{1,2})"
SECOND = "([0-5]?[0-9])"
HOUR12 = "(1[0-2]|0?[1-9])"
GAP = r"(?U:[\s\x1c-\x1f]+)"

ISO = rf"^{YEAR}-{NUM}-{DAY}[Tt]{NUM}:{MINUTE}:{SECOND}\z"
DAY_FIRST = rf"^{DAY}-{NUM}-{YEAR}{GAP}{NUM}:{MINUTE}\z"
MONTH_FIRST = rf"^{NUM}/{DAY}/{YEAR}{GAP}{HOUR12}:{MINUTE}{GAP}[AaPp][Mm]\z"
DATE_ONLY = rf"^{YEAR}/{NUM}/{DAY}\z"


def parse_timestamp(c: Column) -> Column:
    """``timestamp_ntz``, or null where no shape fits or the date does not exist."""
    return timestamp_of(clean(c))


def timestamp_of(text: Column) -> Column:
    """:func:`parse_timestamp` of text that is clean already.

    The shapes exclude one another, and a slash tells two of them from the others, so a row pays
    for at most two tests and one rewrite.
    """

    def rewritten(shape: str, standard: str | Column) -> Column:
        return F.replace(F.regexp_replace(text, shape, standard), F.lit(" "), F.lit("")).try_cast("timestamp_ntz")

    noon_or_midnight = text.rlike(GAP + "12:")
    morning = F.when(noon_or_midnight, "$3-$1-$2T00:$5:00").otherwise("$3-$1-$2T$4:$5:00")
    half_day = F.when(F.lower(text).endswith("pm"), F.expr("INTERVAL '12' HOUR")).otherwise(
        F.expr("INTERVAL '0' HOUR")
    )
    slashes = F.when(text.rlike(MONTH_FIRST), rewritten(MONTH_FIRST, morning) + half_day).when(
        text.rlike(DATE_ONLY), rewritten(DATE_ONLY, "$1-$2-$3T00:00:00")
    )
    dashes = F.when(text.rlike(ISO), rewritten(ISO, "$1-$2-$3T$4:$5:$6")).when(
        text.rlike(DAY_FIRST), rewritten(DAY_FIRST, "$3-$2-$1T$4:$5:00")
    )
    return F.when(F.contains(text, F.lit("/")), slashes).otherwise(dashes)


def iso_text(c: Column) -> Column:
    """``2026-01-05T03:04:05`` for a ``timestamp_ntz``."""
    return F.replace(c.cast("string"), F.lit(" "), F.lit("T"))
