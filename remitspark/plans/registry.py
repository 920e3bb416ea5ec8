"""Every query by name, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from remitspark import sampledata
from remitspark import schema as S
from remitspark.operators import audit as A
from remitspark.operators import validate as V
from remitspark.operators import warehouse
from remitspark.operators.sinks import read_audit, read_rejected
from remitspark.plans.analytics import QUERIES
from remitspark.plans.checks import CHECKS
from remitspark.plans.ingest import ingest, ingest_notifications
from remitspark.session import drop_work_folder, new_work_folder, scratch_folder
from remitspark.sources.notifications import route_notifications
from remitspark.streaming.announced import ingest_announced_stream
from remitspark.streaming.arrivals import ingest_stream
from remitspark.streaming.versions import ingest_versions
from remitspark.tables import fits_broadcast, store

Query = Callable[[SparkSession, str], DataFrame]


#: Queries that show the region.
WITH_REGION = ("amount_by_region", "fraud_by_region", "high_value", "high_value_fraud", "preview")


def _over_transactions(name: str, query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(sampledata.transactions(spark, sf_dir, name in WITH_REGION))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows through the rules, with the checked rows stored once, as the ingest does it."""
    folder = scratch_folder(spark, "checked")
    checked = store(V.check_rows(sampledata.raw_transactions(spark, sf_dir)), f"{folder}/rows")
    repeated = store(V.first_valid(checked), f"{folder}/repeated")
    return V.mark_duplicates(checked, repeated, fits_broadcast(repeated))


def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).select("source_file", "row_pos", "rejection_reason")


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.valid_rows(_annotated(spark, sf_dir))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.rejected_rows(_annotated(spark, sf_dir))


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = V.rejected_rows(_annotated(spark, sf_dir))
    return rejected.groupBy("rejection_reason").agg(F.count("*").alias("row_count"))


def audit_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.audit_rows(A.file_summary(_annotated(spark, sf_dir)))


def partition_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.partition_dates(A.file_summary(_annotated(spark, sf_dir)))


def notification_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sampledata.notifications(spark, sf_dir)
    return route_notifications(log, bucket="landing").select("message_id", "bucket", "key", "status", "error")


def _ingested(spark: SparkSession, sf_dir: str, work: Callable[[str, str], None]) -> str:
    """Folder with the outputs of ``work``, which gets the folders of raw files and outputs."""
    folder, out = new_work_folder(spark, "raw"), scratch_folder(spark, "out")
    try:
        sampledata.write_raw_files(spark, sf_dir, f"{folder}/raw")
        work(f"{folder}/raw", out)
    finally:
        drop_work_folder(spark, folder)
    return out


def _loaded(
    spark: SparkSession,
    outs: Callable[[Callable[[str], None]], None],
    result: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``result`` of the current rows, with their files, of a table into which ``outs`` loads output folders."""
    stored = scratch_folder(spark, "table")
    table = "transactions_" + stored[-32:]
    warehouse.create_transactions(spark, table, location=stored)
    try:
        outs(lambda out: warehouse.load(spark, out, table, mode="incremental"))
        # One file per task; the names in the catalog go with the session's work, the result stays.
        return store(result(warehouse.current_rows(spark, table)), f"{stored}/result")
    finally:
        warehouse.drop_transactions(spark, table)


def _round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files, ingest, load: the rows of the table."""
    out = _ingested(spark, sf_dir, lambda raw, out: ingest(spark, raw, out))
    return _loaded(spark, lambda load: load(out))


def _over_loaded(name: str) -> Query:
    return lambda spark, sf_dir: QUERIES[name](_round_trip(spark, sf_dir))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the loaded table."""
    rows = _round_trip(spark, sf_dir)
    return rows.select(sampledata.batch_name(F.col("source_file")).alias("source_file"), *S.REQUIRED_COLUMNS)


def rejected_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files, ingest, then the rejected rows read back; empty text and none are the same in CSV."""
    out = _ingested(spark, sf_dir, lambda raw, out: ingest(spark, raw, out))
    text = [F.coalesce(c, F.lit("")).alias(c) for c in S.REQUIRED_COLUMNS]
    name = sampledata.batch_name(F.col("source_file")).alias("source_file")
    return read_rejected(spark, out).select(name, *text, "rejection_reason")


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of raw files together with hidden, empty, undecodable and odd ones."""

    def work(raw: str, out: str) -> None:
        sampledata.write_odd_files(spark, raw)
        ingest(spark, raw, out)

    return read_audit(spark, _ingested(spark, sf_dir, work)).select(
        sampledata.batch_name(F.col("source_file")).alias("source_file"),
        "total_valid_records",
        "total_rejected_records",
        "file_error",
    )


def reingest_corrected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest and load, some files sent again on other days and without faults, ingest and load: per file."""
    return _corrected(spark, sf_dir, lambda raw, out, sent: ingest(spark, raw, out, sent))


def stream_reupload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the stream, which finds the files that were sent again."""

    def take(raw: str, out: str, sent: list[str] | None) -> None:
        ingest_versions(spark, raw, out, f"{raw}-checkpoint").awaitTermination()

    return _corrected(spark, sf_dir, take)


def _corrected(spark: SparkSession, sf_dir: str, take: Callable[[str, str, list[str] | None], object]) -> DataFrame:
    """Per file what is there after ``take`` has had all files, and again after some were sent corrected."""
    outs: list[str] = []

    def work(raw: str, out: str) -> None:
        take(raw, out, None)
        load(out)
        take(raw, out, sampledata.send_corrected_files(spark, sf_dir, raw))
        load(out)
        outs.append(out)

    def run(loader: Callable[[str], None]) -> None:
        nonlocal load
        load = loader
        _ingested(spark, sf_dir, work)

    load: Callable[[str], None] = lambda out: None
    name = sampledata.batch_name(F.col("source_file")).alias("source_file")

    def per_file(rows: DataFrame) -> DataFrame:
        return rows.groupBy(name).agg(
            F.count("*").alias("valid_rows"),
            F.sum("amount").cast("decimal(38,2)").alias("valid_amount"),
            F.min("transaction_ts").alias("first_ts"),
            F.max("transaction_ts").alias("last_ts"),
        )

    valid = _loaded(spark, run, per_file)
    rejected = read_rejected(spark, outs[0]).groupBy(name).agg(F.count("*").alias("rejected_rows"))
    return valid.join(rejected, "source_file", "left").fillna(0, ["rejected_rows"])


def ingest_announced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival messages of raw files, and the audit of what they start."""

    def work(raw: str, out: str) -> None:
        log = store(sampledata.announcements(spark, raw), f"{out}/log")
        ingest_notifications(spark, log, raw.removesuffix("/raw"), out, bucket="landing", max_files=100)

    audit = read_audit(spark, _ingested(spark, sf_dir, work))
    name = sampledata.batch_name(F.col("source_file")).alias("source_file")
    return audit.select(name, "total_valid_records", "total_rejected_records", "file_error")


def announced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream that is stopped half way, with all of them sent twice."""

    def work(raw: str, out: str) -> None:
        log = store(sampledata.announcements(spark, raw), f"{out}/log")
        for part in (log.filter(F.crc32("json") % 2 == 0), log, log):
            part.write.mode("append").text(f"{raw}-messages")
            given = (f"{raw}-messages", raw.removesuffix("/raw"), out, f"{raw}-checkpoint")
            ingest_announced_stream(spark, *given, bucket="landing", max_files=100).awaitTermination()

    audit = read_audit(spark, _ingested(spark, sf_dir, work))
    name = sampledata.batch_name(F.col("source_file")).alias("source_file")
    return audit.select(name, "total_valid_records", "total_rejected_records", "file_error")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files picked up by the stream; its audit rows."""

    def work(raw: str, out: str) -> None:
        ingest_stream(spark, raw, out, f"{raw}-checkpoint").awaitTermination()

    return read_audit(spark, _ingested(spark, sf_dir, work)).select(
        sampledata.batch_name(F.col("source_file")).alias("source_file"),
        "total_valid_records",
        "total_rejected_records",
        F.regexp_extract("processed_key", "^(.*/)run_id=", 1).alias("processed_dir"),
        F.regexp_extract("rejected_key", "^(.*/)run_id=", 1).alias("rejected_dir"),
        "file_error",
    )


# The table-structure check is not here: it reads a schema, so its work does not grow with data.
REGISTRY: dict[str, Query] = {
    **{name: _over_transactions(name, query) for name, query in {**QUERIES, **CHECKS}.items() if name != "table_structure"},
    "validate_reasons": validate_reasons,
    "valid_rows": valid_rows,
    "rejected_rows": rejected_rows,
    "rejects_by_reason": rejects_by_reason,
    "audit_by_file": audit_by_file,
    "partition_dates": partition_dates,
    "route_notifications": notification_routes,
    "csv_round_trip": csv_round_trip,
    "loaded_high_value": _over_loaded("high_value"),
    "loaded_failed_declined": _over_loaded("failed_declined"),
    "rejected_round_trip": rejected_round_trip,
    "ingest_audit": ingest_audit,
    "reingest_corrected_files": reingest_corrected_files,
    "ingest_announced": ingest_announced,
    "stream_ingest": stream_ingest,
    "stream_reupload": stream_reupload,
    "announced_stream": announced_stream,
}
