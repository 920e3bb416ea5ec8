"""CSV text rules as column functions on one physical line or one whole record.

A quote opens a quoted field only as the first character of the field; inside, ``""``
is a quote; text after the closing quote belongs to the field up to the next comma.
All quantifiers are possessive: the patterns neither backtrack nor recurse on long text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from remitspark import schema as S

QUOTED_BODY = '[^"]*+(?:""[^"]*+)*+'
FIELD = f'(?:"{QUOTED_BODY}"[^,]*+|[^",][^,]*+|)'
FIELD_WITHOUT_CR = f'(?:"{QUOTED_BODY}"[^,\r]*+|[^",\r][^,\r]*+|)'

COMPLETE = rf"^{FIELD}(?:,{FIELD})*+\z"
COMPLETE_WITHOUT_CR = rf"^{FIELD_WITHOUT_CR}(?:,{FIELD_WITHOUT_CR})*+\z"
CLOSES = rf'^{QUOTED_BODY}"[^,]*+(?:,{FIELD})*+\z'
CLOSES_FIRST = f'^{QUOTED_BODY}"'

QUOTED_FIELD = f'^,"({QUOTED_BODY})"?([^,]*+)'
ANY_FIELD = f',(?:"{QUOTED_BODY}"?[^,]*+|[^",][^,]*+|)'


def has_quote(line: Column) -> Column:
    return F.contains(line, F.lit('"'))


def ends_open_from_outside(line: Column) -> Column:
    """A record that starts on this line goes on in the next one."""
    return has_quote(line) & ~line.rlike(COMPLETE)


def ends_open_from_inside(line: Column) -> Column:
    """A quoted field that is open before this line is still open after it."""
    return ~has_quote(line) | ~line.rlike(CLOSES)


def within_field(line: Column) -> Column:
    """All of a line that starts inside quotes belongs to that field, doubled quotes too."""
    return ~has_quote(line) | ~line.rlike(CLOSES_FIRST)


def trim_line_end(record: Column) -> Column:
    # Only lines that end in one are searched.
    return F.when(record.endswith("\r"), F.rtrim(record, F.lit("\r"))).otherwise(record)


def fields(record: Column) -> Column:
    """``array<string>`` of the record's values."""

    def unquote(token: Column) -> Column:
        body = F.regexp_extract(token, QUOTED_FIELD, 1)
        rest = F.regexp_extract(token, QUOTED_FIELD, 2)
        return F.when(
            token.startswith(',"'), F.concat(F.replace(body, F.lit('""'), F.lit('"')), rest)
        ).otherwise(F.substring(token, 2, 2**31 - 1))

    tokens = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(ANY_FIELD), F.lit(0))
    return F.when(has_quote(record), F.transform(tokens, unquote)).otherwise(F.split(record, ",", -1))


def record_fault(record: Column, max_field_chars: int = S.MAX_FIELD_CHARS) -> Column:
    """Reason why this record makes its whole file unreadable, or null."""
    too_large = (F.length(record) > max_field_chars) & F.exists(
        fields(record), lambda v: F.length(v) > max_field_chars
    )
    stray_cr = F.contains(record, F.lit("\r")) & ~record.rlike(COMPLETE_WITHOUT_CR)
    return (
        F.when(~F.is_valid_utf8(record), S.INVALID_ENCODING)
        .when(too_large, S.FIELD_TOO_LARGE)
        .when(stray_cr, S.STRAY_CARRIAGE_RETURN)
    )
