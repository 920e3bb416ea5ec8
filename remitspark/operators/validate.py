"""The ordered rule chain, first-valid-wins duplicates, and the valid / rejected split.

Input rows have ``source_file``, ``row_pos`` (file order) and the raw text columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from remitspark import functions as R
from remitspark import schema as S
from remitspark.tables import lookup, without_match


MATCH_KEYS = ["source_file", "match_id"]


def check_rows(raw: DataFrame) -> DataFrame:
    """Adds the parsed values and ``fault``: the first failing rule, duplicates aside.

    No shuffle. The projections are stacked so that text which several rules look at is
    cleaned once per row: Spark does not merge projections that would repeat such work.
    """
    cleaned = raw.withColumns(
        {
            "clean_id": R.clean(F.col("transaction_id")),
            "clean_ts": R.clean(F.col("transaction_ts")),
            "clean_amount": R.clean(F.col("amount")),
        }
    ).withColumn("amount_literal", R.literal_of(F.col("clean_amount")))
    parsed = cleaned.withColumns(
        {
            "parsed_ts": R.timestamp_of(F.col("clean_ts")),
            "parsed_amount": R.decimal_of(F.col("amount_literal")),
        }
    )
    stored = F.when(F.col("fault").isNull(), R.stored_amount(F.col("amount_literal")))
    return (
        parsed.withColumn("fault", _first_fault())
        .withColumn("parsed_amount", stored)
        .drop("clean_ts", "clean_amount", "amount_literal")
    )


def _first_fault() -> Column:
    raw_ts = F.coalesce(F.col("transaction_ts"), F.lit(""))
    return F.coalesce(
        F.when(F.col("clean_id") == "", S.MISSING_TRANSACTION_ID),
        F.when(raw_ts == "", S.EMPTY_TIMESTAMP),
        F.when(F.col("parsed_ts").isNull(), S.INVALID_TIMESTAMP),
        R.amount_fault(F.col("clean_amount"), F.col("amount_literal"), F.col("parsed_amount")),
        F.when(~R.clean_choice(F.col("currency"), S.CURRENCIES).isin(S.CURRENCIES), S.INVALID_CURRENCY),
        F.when(~R.clean_choice(F.col("status"), S.STATUSES).isin(S.STATUSES), S.INVALID_STATUS),
        F.when(R.clean(F.col("merchant_id")) == "", S.MISSING_MERCHANT_ID),
        F.when(R.clean(F.col("payment_method_id")) == "", S.MISSING_PAYMENT_METHOD_ID),
        F.when(R.clean(F.col("region")) == "", S.MISSING_REGION),
    )


def first_valid(checked: DataFrame) -> DataFrame:
    """Position of the first valid row of every id that has a later row in its file.

    Aggregated before the shuffle, so an id that fills a third of a file sends one row
    per task. Only ids with something to reject remain. The two keys are grouped as one
    struct: grouped one by one, a join on them would reuse this shuffle, and adaptive
    execution splits hot keys only in joins whose sides both come from their own shuffle.
    """
    return (
        checked.filter(F.col("clean_id") != "")
        .groupBy(F.struct("source_file", "clean_id").alias("key"))
        .agg(
            F.min(F.when(F.col("fault").isNull(), F.col("row_pos"))).alias("first_valid_pos"),
            F.max("row_pos").alias("last_pos"),
            F.count("*").alias("row_count"),
        )
        .filter(F.col("last_pos") > F.col("first_valid_pos"))
        .select("key.source_file", F.col("key.clean_id").alias("match_id"), "first_valid_pos", "row_count")
    )


def mark_duplicates(checked: DataFrame, repeated: DataFrame, small: bool | None = None) -> DataFrame:
    """Adds ``rejection_reason`` (null for valid rows).

    A duplicate outranks every rule but the missing id. Rows without an id get a match
    key of their own, with a leading space that no cleaned id has: they match nothing and
    spread over all partitions. ``small`` says whether a stored ``repeated`` fits a
    broadcast. Without it the join is a plain left join, of which adaptive execution may
    split the hot keys.
    """
    keyed = _with_match_id(checked)
    if small is None:
        joined = keyed.join(repeated.drop("row_count"), MATCH_KEYS, "left")
    else:
        joined = lookup(keyed, repeated, MATCH_KEYS, "row_count", F.col("row_pos"), small, sparse=True)
    return _with_reason(joined)


def mark_in_parts(checked: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`mark_duplicates` by a stored ``repeated`` that is too large for a broadcast, as two parts.

    Rows of the first part surely have no match and stay in the tasks that read them. Rows of the
    second may have one and are shuffled.
    """
    may, never = without_match(_with_match_id(checked), repeated, MATCH_KEYS)
    found = lookup(may, repeated, MATCH_KEYS, "row_count", F.col("row_pos"), small=False)
    alone = never.withColumn("first_valid_pos", F.lit(None).cast("long"))
    return _with_reason(alone), _with_reason(found)


def _with_match_id(checked: DataFrame) -> DataFrame:
    match_id = F.when(F.col("clean_id") == "", F.concat(F.lit(" "), F.col("row_pos"))).otherwise(
        F.col("clean_id")
    )
    return checked.withColumn("match_id", match_id)


def _with_reason(joined: DataFrame) -> DataFrame:
    reason = F.when(F.col("row_pos") > F.col("first_valid_pos"), S.DUPLICATE_TRANSACTION_ID).otherwise(
        F.col("fault")
    )
    return joined.withColumn("rejection_reason", reason).drop("match_id", "first_valid_pos", "fault")


def annotate(raw: DataFrame) -> DataFrame:
    """Lazy: raw rows to rows with parsed values and ``rejection_reason``."""
    checked = check_rows(raw)
    return mark_duplicates(checked, first_valid(checked))


def valid_rows(annotated: DataFrame) -> DataFrame:
    """Normalised, typed records plus ``source_file`` and ``row_pos``."""
    return annotated.filter(F.col("rejection_reason").isNull()).select(
        F.col("clean_id").alias("transaction_id"),
        F.col("parsed_ts").alias("transaction_ts"),
        R.clean(F.col("merchant_id")).alias("merchant_id"),
        R.blank_to_null(F.col("customer_id")).alias("customer_id"),
        R.clean(F.col("payment_method_id")).alias("payment_method_id"),
        F.col("parsed_amount").alias("amount"),
        R.clean_choice(F.col("currency"), S.CURRENCIES).alias("currency"),
        R.clean_choice(F.col("status"), S.STATUSES).alias("status"),
        R.flag(F.col("is_fraud_flag")).alias("is_fraud_flag"),
        R.blank_to_null(F.col("device_type")).alias("device_type"),
        R.clean(F.col("region")).alias("region"),
        "source_file",
        "row_pos",
    )


def rejected_rows(annotated: DataFrame) -> DataFrame:
    """Untouched raw text plus the reason, ``source_file`` and ``row_pos``."""
    return annotated.filter(F.col("rejection_reason").isNotNull()).select(
        *S.REQUIRED_COLUMNS, "rejection_reason", "source_file", "row_pos"
    )
