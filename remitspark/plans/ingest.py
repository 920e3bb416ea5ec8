"""From raw CSV files to processed Parquet, rejected CSV and audit rows; then the load."""

from __future__ import annotations

import uuid
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F

from remitspark import schema as S
from remitspark.operators import audit as A
from remitspark.operators import sinks
from remitspark.operators import validate as V
from remitspark.operators import warehouse
from remitspark.session import drop_work_folder, new_work_folder, scratch_folder
from remitspark.sources.csv_files import read_raw, unseen_files, without_headers
from remitspark.sources.notifications import ACCEPTED, route_notifications
from remitspark.sources.records import literal_path
from remitspark.tables import fits_broadcast, lookup, store


def ingest(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    paths: list[str] | None = None,
    partition_by: str = "file",
    run_id: str | None = None,
    max_field_chars: int = S.MAX_FIELD_CHARS,
) -> DataFrame:
    """Processes every CSV file below ``raw_dir``, or only ``paths``; returns its audit rows.

    An empty list of paths processes nothing. A run id names one set of files: running it
    again replaces its output.

    ``partition_by="file"`` puts a whole file under the date of its first valid row,
    ``"row"`` puts each row under its own date. A file that cannot be read gets an audit
    row with ``file_error`` and does not hold up the others.

    The text is read twice (once to learn the headers and quoting, once to parse) and every
    rule runs once per row; all later steps read columns of the parsed table.
    """
    if partition_by not in ("file", "row"):
        raise ValueError(f"partition_by must be 'file' or 'row', not {partition_by!r}")
    if paths is not None and not paths:
        return spark.createDataFrame([], S.AUDIT)
    run_id = run_id or uuid.uuid4().hex
    folder = new_work_folder(spark, "ingest")
    try:
        checked, files = read_raw(spark, raw_dir, paths, folder, V.check_rows, max_field_chars)
        repeated = store(V.first_valid(checked), f"{folder}/repeated")
        few_repeated = fits_broadcast(repeated)
        if few_repeated:
            marked = stays = V.mark_duplicates(checked, repeated, True)
            shuffled = None
        else:
            stays, shuffled = V.mark_in_parts(checked, repeated)
            # Only rows of ids that may be repeated are shuffled; stored, so that it happens once.
            shuffled = store(shuffled, f"{folder}/shuffled")
            marked = stays.unionByName(shuffled)
        summary = store(A.file_summary(marked), f"{folder}/summary")

        if partition_by == "file":
            dates = A.partition_dates(summary, "total_valid_records")
            few_files = fits_broadcast(dates)
            day, regroup = F.col("partition_date"), not few_files
        else:
            day, regroup = F.col("transaction_ts"), True
        valid, scattered = V.valid_rows(marked), None
        if shuffled is not None and not regroup:
            valid, scattered = V.valid_rows(stays), V.valid_rows(shuffled)
        if partition_by == "file":
            by_file = (dates, ["source_file"], "total_valid_records", F.col("row_pos"), few_files)
            valid = lookup(valid, *by_file)
            scattered = scattered and lookup(scattered, *by_file)
        rejected = without_headers(V.rejected_rows(marked), summary, "total_rejected_records")

        sinks.write_rejected(rejected, f"{out_dir}/rejected", run_id)
        sinks.write_processed(valid, day, f"{out_dir}/processed", run_id, regroup, scattered)
        # Last: rows of a run without an audit row are not loaded.
        sinks.write_audit(_audit(files, summary, run_id, partition_by), f"{out_dir}/audit")
    finally:
        drop_work_folder(spark, folder)
    return sinks.read_audit(spark, out_dir).filter(F.col("run_id") == run_id)


def audit_unseen(spark: SparkSession, raw_dir: str, out_dir: str) -> DataFrame:
    """Audit rows for files that the stream does not see: without a byte, or with a hidden name.

    To be called beside the stream from time to time. Files whose last audit row says the same
    already get none. Returns the new rows.
    """
    run_id, files = uuid.uuid4().hex, unseen_files(spark, raw_dir)
    if sinks.has_audit(spark, out_dir):
        audit = sinks.read_audit(spark, out_dir)
        known = sinks.current(audit, audit).select("source_file", "file_error")
        files = files.join(known, ["source_file", "file_error"], "left_anti")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("string")
    rows = files.withColumns({"total_valid_records": zero, "total_rejected_records": zero, "processed_key": none, "rejected_key": none})
    rows = store(rows.withColumns({"run_id": F.lit(run_id), "run_time": F.current_timestamp()}), scratch_folder(spark, "unseen"))
    if not rows.isEmpty():
        sinks.write_audit(rows, f"{out_dir}/audit")
    return rows.select(S.AUDIT.fieldNames())


def _audit(files: DataFrame, summary: DataFrame, run_id: str, partition_by: str) -> DataFrame:
    """One row per admitted file. The header row counts as rejected up to here; not below."""
    data_rows = summary.withColumn("total_rejected_records", F.col("total_rejected_records") - 1)
    rows = (
        files.join(A.audit_rows(data_rows), "source_file", "left")
        .fillna(0, ["total_valid_records", "total_rejected_records"])
        .withColumns({"run_id": F.lit(run_id), "run_time": F.current_timestamp()})
    )
    return A.with_run_keys(rows, partition_by)


def ingest_and_load(
    spark: SparkSession, raw_dir: str, out_dir: str, table: str = "transactions", **options
) -> DataFrame:
    """Ingest, then load files that the table does not hold yet. Returns the audit rows."""
    audit = ingest(spark, raw_dir, out_dir, **options)
    warehouse.load(spark, out_dir, table, mode="incremental")
    return audit


def ingest_notifications(
    spark: SparkSession, log: DataFrame, raw_dir: str, out_dir: str, bucket: str, max_files: int = 1000, **options
) -> DataFrame:
    """Processes the files that a log of arrival messages accepts; returns their audit rows.

    Keys are relative to ``raw_dir``, which holds the bucket. Each file is processed once
    however often it was announced, at most ``max_files`` in a run; only their names come here.
    """
    folder, run_ids = new_work_folder(spark, "announced"), []
    try:
        accepted = route_notifications(log, bucket).filter((F.col("status") == ACCEPTED) & (F.col("bucket") == bucket))
        keys = store(accepted.select("key").distinct().sort("key"), folder)
        names = (f"{raw_dir.rstrip('/')}/{row['key']}" for row in keys.toLocalIterator())
        while chunk := list(islice(names, max_files)):
            run_ids.append(uuid.uuid4().hex)
            ingest(spark, raw_dir, out_dir, [literal_path(name) for name in chunk], run_id=run_ids[-1], **options)
    finally:
        drop_work_folder(spark, folder)
    if not run_ids:
        return spark.createDataFrame([], S.AUDIT)
    return sinks.read_audit(spark, out_dir).filter(F.col("run_id").isin(run_ids))
