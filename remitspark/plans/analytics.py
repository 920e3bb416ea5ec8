"""The 25 analytic queries over ``transactions``.

Each takes the table as a DataFrame. Grouped queries aggregate inside each task first,
so a key that holds a third of the rows sends one row per task. Ties in the order fall to
the group key, or to the transaction id.

Fixed values: the names of results and the filters' literals, which callers know.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from remitspark import schema as S

IS_FRAUD = "is_fraud_flag"


def _sum() -> Column:
    return F.sum("amount").cast("decimal(38,2)")


def _avg() -> Column:
    return F.try_divide(F.sum("amount").cast("double"), F.count("amount"))


def _percentage(condition: Column) -> Column:
    return F.try_divide(F.count_if(condition).cast("double") * 100, F.count("*"))


def _success() -> Column:
    return F.col("status") == "SUCCESS"


def _by(tx: DataFrame, key: str, aggregates: dict[str, Column], largest: str) -> DataFrame:
    return (
        tx.groupBy(key)
        .agg(*[c.alias(name) for name, c in aggregates.items()])
        .orderBy(F.desc(largest), F.asc_nulls_last(key))
    )


def _over_time(tx: DataFrame, period: Column, name: str, aggregates: dict[str, Column]) -> DataFrame:
    return (
        tx.groupBy(period.alias(name)).agg(*[c.alias(n) for n, c in aggregates.items()]).orderBy(name)
    )


# Whole table


def total_transactions(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count("*").alias("total_transactions"))


def total_amount(tx: DataFrame) -> DataFrame:
    return tx.agg(_sum().alias("total_transaction_amount"))


def average_amount(tx: DataFrame) -> DataFrame:
    return tx.agg(_avg().alias("average_transaction_amount"))


def min_max_amount(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.min("amount").alias("minimum_transaction_amount"),
        F.max("amount").alias("maximum_transaction_amount"),
    )


# By one column


def count_by_status(tx: DataFrame) -> DataFrame:
    return _by(tx, "status", {"transaction_count": F.count("*")}, "transaction_count")


def _amount_by(tx: DataFrame, key: str) -> DataFrame:
    return _by(
        tx,
        key,
        {"transaction_count": F.count("*"), "total_amount": _sum(), "average_amount": _avg()},
        "total_amount",
    )


def amount_by_status(tx: DataFrame) -> DataFrame:
    return _amount_by(tx, "status")


def amount_by_currency(tx: DataFrame) -> DataFrame:
    return _amount_by(tx, "currency")


def amount_by_region(tx: DataFrame) -> DataFrame:
    return _amount_by(tx, "region")


def merchant_performance(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        "merchant_id",
        {
            "transaction_count": F.count("*"),
            "total_transaction_amount": _sum(),
            "average_transaction_amount": _avg(),
        },
        "total_transaction_amount",
    )


def top_merchants(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        "merchant_id",
        {"transaction_count": F.count("*"), "total_transaction_amount": _sum()},
        "total_transaction_amount",
    ).limit(10)


def amount_by_device(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        "device_type",
        {"transaction_count": F.count("*"), "total_amount": _sum()},
        "transaction_count",
    )


def amount_by_payment_method(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        "payment_method_id",
        {"transaction_count": F.count("*"), "total_amount": _sum()},
        "total_amount",
    )


def top_customers(tx: DataFrame) -> DataFrame:
    return _by(
        tx.filter(F.col("customer_id").isNotNull()),
        "customer_id",
        {
            "transaction_count": F.count("*"),
            "total_amount": _sum(),
            "average_transaction_amount": _avg(),
        },
        "total_amount",
    ).limit(20)


# Fraud


def fraud_count(tx: DataFrame) -> DataFrame:
    return tx.filter(IS_FRAUD).agg(F.count("*").alias("fraud_transaction_count"))


def fraud_amount(tx: DataFrame) -> DataFrame:
    return tx.filter(IS_FRAUD).agg(_sum().alias("fraud_transaction_amount"))


def fraud_by_region(tx: DataFrame) -> DataFrame:
    return _by(
        tx.filter(IS_FRAUD),
        "region",
        {"fraud_transaction_count": F.count("*"), "fraud_amount": _sum()},
        "fraud_amount",
    )


def fraud_rate(tx: DataFrame) -> DataFrame:
    return tx.agg(_percentage(F.col(IS_FRAUD)).alias("fraud_rate_percentage"))


# Outcome


def failed_declined(tx: DataFrame) -> DataFrame:
    return _by(
        tx.filter(F.col("status").isin("FAILED", "DECLINED")),
        "status",
        {"transaction_count": F.count("*"), "total_amount": _sum()},
        "transaction_count",
    )


def success_rate(tx: DataFrame) -> DataFrame:
    return tx.agg(_percentage(_success()).alias("success_rate_percentage"))


def merchant_success_rate(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        "merchant_id",
        {
            "total_transactions": F.count("*"),
            "successful_transactions": F.count_if(_success()),
            "success_rate_percentage": _percentage(_success()),
        },
        "success_rate_percentage",
    )


# Over time


def daily_volume(tx: DataFrame) -> DataFrame:
    return _over_time(
        tx,
        F.col("transaction_ts").cast("date"),
        "transaction_date",
        {"transaction_count": F.count("*"), "total_amount": _sum()},
    )


def daily_success_amount(tx: DataFrame) -> DataFrame:
    return _over_time(
        tx.filter(_success()),
        F.col("transaction_ts").cast("date"),
        "transaction_date",
        {"successful_transactions": F.count("*"), "successful_transaction_amount": _sum()},
    )


def monthly_volume(tx: DataFrame) -> DataFrame:
    # Truncating the date, not the timestamp, keeps the session time zone out of it.
    month = F.trunc(F.col("transaction_ts").cast("date"), "month").cast("timestamp_ntz")
    return _over_time(
        tx, month, "transaction_month", {"transaction_count": F.count("*"), "total_amount": _sum()}
    )


# High value


def _largest_first(tx: DataFrame, columns: list[str]) -> DataFrame:
    # The id as second sort key also spreads a hot amount over range partitions.
    return (
        tx.filter(F.col("amount") > S.HIGH_VALUE)
        .select(columns)
        .orderBy(F.desc("amount"), "transaction_id", "transaction_ts")
    )


def high_value(tx: DataFrame) -> DataFrame:
    return _largest_first(
        tx,
        [
            "transaction_id",
            "transaction_ts",
            "merchant_id",
            "customer_id",
            "amount",
            "currency",
            "status",
            "is_fraud_flag",
            "region",
        ],
    )


def high_value_fraud(tx: DataFrame) -> DataFrame:
    return _largest_first(
        tx.filter(IS_FRAUD),
        [
            "transaction_id",
            "transaction_ts",
            "merchant_id",
            "customer_id",
            "amount",
            "currency",
            "status",
            "region",
        ],
    )


QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        total_transactions,
        total_amount,
        average_amount,
        min_max_amount,
        count_by_status,
        amount_by_status,
        amount_by_currency,
        merchant_performance,
        top_merchants,
        amount_by_region,
        amount_by_device,
        amount_by_payment_method,
        fraud_count,
        fraud_amount,
        fraud_by_region,
        fraud_rate,
        daily_volume,
        daily_success_amount,
        failed_declined,
        success_rate,
        merchant_success_rate,
        high_value,
        high_value_fraud,
        monthly_volume,
        top_customers,
    )
}
