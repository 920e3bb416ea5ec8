"""Per-file summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from remitspark import functions as R


def file_summary(annotated: DataFrame) -> DataFrame:
    """One row per file: counts, first position and time of the first valid row.

    Every buffer is fixed-width, so a hot file is reduced inside each task by hash.
    """
    ok = F.col("rejection_reason").isNull()
    return annotated.groupBy("source_file").agg(
        F.count_if(ok).alias("total_valid_records"),
        F.count_if(~ok).alias("total_rejected_records"),
        F.min("row_pos").alias("first_pos"),
        F.min_by("parsed_ts", F.when(ok, F.col("row_pos"))).alias("first_valid_ts"),
    )


def audit_rows(summary: DataFrame) -> DataFrame:
    """Run result per file: counts and output names, null where nothing is written."""
    name = F.col("source_file")
    return summary.select(
        "source_file",
        "total_valid_records",
        "total_rejected_records",
        F.when(F.col("total_valid_records") > 0, R.processed_key(name, F.col("first_valid_ts"))).alias(
            "processed_key"
        ),
        F.when(F.col("total_rejected_records") > 0, R.rejected_key(name)).alias("rejected_key"),
    )


def with_run_keys(audit: DataFrame, partition_by: str) -> DataFrame:
    """The directories of a run in place of names per file: rows of a file are in those."""
    day = F.regexp_extract("processed_key", "^processed/(.*)/[^/]*$", 1) if partition_by == "file" else F.lit("year=*/month=*/day=*")
    run = F.concat(F.lit("/run_id="), F.col("run_id"))
    return audit.withColumns(
        {
            "processed_key": F.when(F.col("processed_key").isNotNull(), F.concat(F.lit("processed/"), day, run)),
            "rejected_key": F.when(F.col("rejected_key").isNotNull(), F.concat(F.lit("rejected"), run)),
        }
    )


def partition_dates(summary: DataFrame, *more: str) -> DataFrame:
    """Date of each file's first valid row, which names the directory of the whole file."""
    return summary.filter(F.col("first_valid_ts").isNotNull()).select(
        "source_file", F.col("first_valid_ts").cast("date").alias("partition_date"), *more
    )
