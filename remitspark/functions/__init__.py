"""Column functions: each takes and returns a Column and stays inside the JVM."""

from remitspark.functions.amounts import amount_fault, decimal_of, literal_of, parse_amount, stored_amount
from remitspark.functions.naming import is_csv, processed_key, rejected_key
from remitspark.functions.text import blank_to_null, clean, clean_choice, clean_upper, flag
from remitspark.functions.timestamps import iso_text, parse_timestamp, timestamp_of

__all__ = [
    "amount_fault",
    "blank_to_null",
    "clean",
    "clean_choice",
    "clean_upper",
    "decimal_of",
    "flag",
    "is_csv",
    "iso_text",
    "literal_of",
    "parse_amount",
    "parse_timestamp",
    "processed_key",
    "rejected_key",
    "stored_amount",
    "timestamp_of",
]
