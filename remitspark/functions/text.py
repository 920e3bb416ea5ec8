"""Text normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Every character that Python's str.strip() removes; all lie in the basic plane.
WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())


def clean(c: Column) -> Column:
    """Null becomes '', outer Unicode whitespace goes.

    Text that starts and ends with a printing ASCII character, as most does, is not searched.
    """
    text = F.coalesce(c, F.lit(""))
    bare = text.between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def clean_upper(c: Column) -> Column:
    return F.upper(clean(c))


def clean_choice(c: Column, choices: Iterable[str]) -> Column:
    """:func:`clean_upper`; text that is one of ``choices``, clean and in upper case, is taken as it is."""
    return F.when(c.isin(*choices), c).otherwise(clean_upper(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(clean(c), F.lit(""))


def flag(c: Column) -> Column:
    """True only for the text '1'; never null."""
    return clean(c) == "1"
