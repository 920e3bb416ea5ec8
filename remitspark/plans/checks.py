"""Checks after a load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from remitspark import schema as S
from remitspark.operators.warehouse import describe_transactions
from remitspark.plans.analytics import count_by_status


def loaded_count(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count("*").alias("total_loaded_records"))


def preview(tx: DataFrame) -> DataFrame:
    """Ten rows; the smallest ids, so that the choice is stable."""
    return tx.select(S.REQUIRED_COLUMNS).orderBy("transaction_id").limit(10)


def date_range(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.min("transaction_ts").alias("earliest_transaction"),
        F.max("transaction_ts").alias("latest_transaction"),
    )


CHECKS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "loaded_count": loaded_count,
    "preview": preview,
    "date_range": date_range,
    "status_distribution": count_by_status,
    "table_structure": describe_transactions,
}
