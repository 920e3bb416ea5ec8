"""Object-arrival notifications: a log of JSON messages to bucket, key and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from remitspark.functions import is_csv

# The envelopes' field names and constants.
_OBJECT = "struct<bucket: struct<name: string>, object: struct<key: string, sequencer: string>>"
ENVELOPE = (
    f"source string, `detail-type` string, detail {_OBJECT}, Records array<struct<s3: {_OBJECT}>>"
)
BUS_SOURCE = "aws.s3"
BUS_DETAIL_TYPE = "Object Created"

ACCEPTED = "ACCEPTED"
IGNORED = "IGNORED_NON_CSV"
NOT_MATCHED = "NOT_MATCHED"
INVALID = "INVALID_S3_EVENT"
UNSUPPORTED = "UNSUPPORTED_EVENT_FORMAT"


def decode_key(key: Column) -> Column:
    """Plus becomes a space, %xx its byte; a percent sign that starts no code stays."""
    return F.url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def route_notifications(
    log: DataFrame, bucket: str | None = None, prefix: str = "raw/"
) -> DataFrame:
    """Adds ``bucket``, ``key``, ``sequencer``, ``status`` and ``error`` to rows with a ``json`` column.

    Bus events and direct notifications are understood; a direct one gives a row per
    record. ``bucket`` and ``prefix`` are the subscription: a bus event outside of them
    starts nothing. Direct notifications are delivered by a subscription of their own.
    """
    event = F.from_json("json", ENVELOPE)
    is_bus = F.coalesce(
        (F.col("event.source") == BUS_SOURCE) & (F.col("event.detail-type") == BUS_DETAIL_TYPE), F.lit(False)
    )
    records = F.col("event.Records.s3")
    has_records = F.coalesce(F.array_contains(F.json_object_keys("json"), "Records"), F.lit(False))
    found = F.when(is_bus, F.array("event.detail")).otherwise(records)
    rows = (
        log.withColumn("event", event)
        .withColumns({"is_bus": is_bus, "found": found, "has_records": has_records})
        .withColumn("is_known", F.col("is_bus") | F.col("has_records"))
        .withColumn("object", F.explode_outer("found"))
        .withColumns({"bucket": F.col("object.bucket.name"), "raw_key": F.col("object.object.key")})
        .withColumn("sequencer", F.col("object.object.sequencer"))
    )
    valid = F.col("bucket").isNotNull() & F.col("raw_key").isNotNull()
    subscribed = F.col("raw_key").startswith(prefix)
    if bucket is not None:
        subscribed = subscribed & (F.col("bucket") == bucket)
    key = F.when(valid, decode_key(F.col("raw_key")))
    status = (
        F.when(~valid, INVALID)
        .when(F.col("is_bus") & ~subscribed, NOT_MATCHED)
        .when(~is_csv(F.col("key")), IGNORED)
        .otherwise(ACCEPTED)
    )
    error = F.when(~valid, F.when(F.col("is_known"), INVALID).otherwise(UNSUPPORTED))
    return (
        rows.withColumn("key", key)
        .withColumns({"status": status, "error": error})
        .withColumn("bucket", F.when(valid, F.col("bucket")))
        .drop("event", "is_bus", "found", "has_records", "is_known", "object", "raw_key")
    )
