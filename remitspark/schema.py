"""Column contracts, value domains and reason codes shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# The record layout.
REQUIRED_COLUMNS = [
    "transaction_id",
    "transaction_ts",
    "merchant_id",
    "customer_id",
    "payment_method_id",
    "amount",
    "currency",
    "status",
    "is_fraud_flag",
    "device_type",
    "region",
]

# Accepted domains.
STATUSES = ["SUCCESS", "FAILED", "DECLINED", "REFUNDED", "PENDING"]
CURRENCIES = ["INR", "USD"]
MIN_AMOUNT = "0.01"
MAX_AMOUNT = "10000000.00"

# Row rejection reasons, in the order the rules are tried.
MISSING_TRANSACTION_ID = "MISSING_TRANSACTION_ID"
DUPLICATE_TRANSACTION_ID = "DUPLICATE_TRANSACTION_ID"
EMPTY_TIMESTAMP = "EMPTY_TIMESTAMP"
INVALID_TIMESTAMP = "INVALID_TIMESTAMP"
EMPTY_AMOUNT = "EMPTY_AMOUNT"
INVALID_AMOUNT = "INVALID_AMOUNT"
AMOUNT_OUT_OF_RANGE = "AMOUNT_OUT_OF_RANGE"
INVALID_CURRENCY = "INVALID_CURRENCY"
INVALID_STATUS = "INVALID_STATUS"
MISSING_MERCHANT_ID = "MISSING_MERCHANT_ID"
MISSING_PAYMENT_METHOD_ID = "MISSING_PAYMENT_METHOD_ID"
MISSING_REGION = "MISSING_REGION"

# Whole-file failures.
MISSING_REQUIRED_COLUMNS = "MISSING_REQUIRED_COLUMNS"
FIELD_TOO_LARGE = "FIELD_TOO_LARGE"
STRAY_CARRIAGE_RETURN = "STRAY_CARRIAGE_RETURN"
INVALID_ENCODING = "INVALID_ENCODING"
HIDDEN_NAME = "HIDDEN_NAME"

# Longest CSV field, in characters, that a file may hold unless the caller says otherwise
# (Python's csv default).
MAX_FIELD_CHARS = 131072

# Strict lower bound of a "high value" transaction.
HIGH_VALUE = 100000

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("transaction_ts", T.TimestampNTZType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("payment_method_id", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("is_fraud_flag", T.BooleanType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

# Directory columns of the processed dataset. Strings, so that "01" stays "01".
PROCESSED_PARTITIONS = ["year", "month", "day", "run_id"]

PROCESSED = T.StructType(
    TRANSACTIONS.fields + [T.StructField(c, T.StringType()) for c in ["source_file", *PROCESSED_PARTITIONS]]
)

REJECTED = T.StructType(
    [T.StructField(c, T.StringType()) for c in REQUIRED_COLUMNS]
    + [T.StructField(c, T.StringType()) for c in ("rejection_reason", "source_file", "run_id")]
)

AUDIT = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("total_valid_records", T.LongType()),
        T.StructField("total_rejected_records", T.LongType()),
        T.StructField("processed_key", T.StringType()),
        T.StructField("rejected_key", T.StringType()),
        T.StructField("file_error", T.StringType()),
        T.StructField("run_time", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)
