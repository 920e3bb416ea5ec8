"""Decimal amounts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from remitspark import schema as S
from remitspark.functions.text import clean

NUMBER = r"^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?))\z"

# Exponents that no decimal number may have: over 18 digits, or below -2 * 10**18.
NO_EXPONENT = r"[eE](?:\+?0*[1-9][0-9]{18,}|-0*(?:[2-9][0-9]{18}|[1-9][0-9]{19,}))\z"

# Text with more digits than the decimal holds may round onto a limit from the wrong side:
# onto 0.01 if its first digit is a 9, onto 10000000 if a digit follows its leading 1.
ROUNDS_UP_TO_MIN = r"^\+?[0.]*9"
ROUNDS_DOWN_TO_MAX = r"^\+?[0.]*1[0.]*[1-9]"


def literal_of(text: Column) -> Column:
    """Clean text without the underscores that may group digits."""
    return F.replace(text, F.lit("_"), F.lit(""))


def decimal_of(literal: Column, kind: str = "decimal(38,28)") -> Column:
    """Null for non-numbers and for exponents that the digits of the text cannot make up for.

    Such a number is out of range, and converting it would build a huge integer.
    """
    exponent = F.regexp_extract(literal, "[eE][+-]?([0-9]+)", 1).try_cast("int")
    far = literal.rlike("[eE]") & (F.coalesce(exponent, F.lit(2**31 - 1)) > F.length(literal) + 10)
    return F.when(literal.rlike(NUMBER) & ~far, literal.try_cast(kind))


def parse_amount(c: Column) -> Column:
    """``decimal(38,28)``, or null where the text is no number or far out of range."""
    return decimal_of(literal_of(clean(c)))


def amount_fault(text: Column, literal: Column, parsed: Column) -> Column:
    """Reason code for clean text, its :func:`literal_of` and its :func:`decimal_of`, or null."""
    low = F.lit(S.MIN_AMOUNT).cast("decimal(38,28)")
    high = F.lit(S.MAX_AMOUNT).cast("decimal(38,28)")
    below = (parsed < low) | ((parsed == low) & literal.rlike(ROUNDS_UP_TO_MIN))
    above = (parsed > high) | ((parsed == high) & literal.rlike(ROUNDS_DOWN_TO_MAX))
    return (
        F.when(text == "", S.EMPTY_AMOUNT)
        .when(parsed.isNull() & (~literal.rlike(NUMBER) | literal.rlike(NO_EXPONENT)), S.INVALID_AMOUNT)
        .when(parsed.isNull() | below | above, S.AMOUNT_OUT_OF_RANGE)
    )


def stored_amount(literal: Column) -> Column:
    """``decimal(18,2)``, rounded half up once, for text that passed :func:`amount_fault`."""
    return decimal_of(literal, "decimal(18,2)")
