"""Processed, rejected and audit datasets, by run.

Every run writes directories of its own, and the audit says which runs a file was in. The
current version of a file is that of its latest run. Readers leave older versions out, so a
corrected file replaces its old rows wherever they were, also if its date has changed or
nothing is rejected any more. A run that is repeated under its id replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from remitspark import schema as S
from remitspark.tables import fits_broadcast


def _date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day).cast("string"),
        "month": F.lpad(F.month(day).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    }


def write_processed(
    valid: DataFrame, day: Column, path: str, run_id: str, regroup: bool, scattered: DataFrame | None = None
) -> None:
    """Snappy Parquet under ``year=/month=/day=/run_id=``; no rows, no output.

    ``regroup`` brings rows of a date together that a shuffled join or per-row dates have
    spread; it cuts hot partitions into several tasks and packs small ones. ``scattered`` are
    more valid rows, which alone are regrouped if the others stand as their files do.
    """

    def placed(rows: DataFrame, regroup: bool) -> DataFrame:
        out = rows.withColumns(_date_parts(day)).withColumn("run_id", F.lit(run_id)).select(S.PROCESSED.fieldNames())
        return out.hint("rebalance", *S.PROCESSED_PARTITIONS) if regroup else out

    if scattered is None or regroup:
        out = placed(valid if scattered is None else valid.unionByName(scattered), regroup)
    else:
        out = placed(valid, False).unionByName(placed(scattered, True))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        # Ids hardly repeat: no dictionary of them is tried.
        .option("parquet.enable.dictionary#transaction_id", "false")
        .partitionBy(*S.PROCESSED_PARTITIONS)
        .parquet(path)
    )


def write_rejected(rejected: DataFrame, path: str, run_id: str) -> None:
    """CSV with header under ``run_id=``: raw text as it came, plus the reason and the file."""
    (
        rejected.withColumn("run_id", F.lit(run_id))
        .hint("rebalance", "source_file")
        .sortWithinPartitions("source_file", "row_pos")
        .select(S.REJECTED.fieldNames())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("run_id")
        .csv(path)
    )


def write_audit(audit: DataFrame, path: str) -> None:
    (
        audit.select(S.AUDIT.fieldNames())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def superseded(audit: DataFrame) -> DataFrame:
    """``source_file, run_id`` of every run of a file that a later run of it replaces."""
    last = audit.groupBy(F.col("source_file").alias("file")).agg(F.max(F.struct("run_time", "run_id")).alias("last"))
    joined = audit.join(last, F.col("source_file") == F.col("file"))
    return joined.filter(F.col("run_id") != F.col("last.run_id")).select("source_file", "run_id").distinct()


def current(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows that no later run of their file replaces."""
    old = superseded(audit)
    return rows.join(F.broadcast(old) if fits_broadcast(old) else old, ["source_file", "run_id"], "left_anti")


def all_processed(spark, out_dir: str) -> DataFrame:
    """Valid rows of all runs, also of those that later ones replace."""
    return spark.read.schema(S.PROCESSED).parquet(f"{out_dir}/processed")


def read_processed(spark, out_dir: str) -> DataFrame:
    rows = current(all_processed(spark, out_dir), read_audit(spark, out_dir))
    return rows.select(S.PROCESSED.fieldNames())


def read_rejected(spark, out_dir: str) -> DataFrame:
    rows = (
        spark.read.schema(S.REJECTED)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{out_dir}/rejected")
    )
    return current(rows, read_audit(spark, out_dir)).select(S.REJECTED.fieldNames())


def has_audit(spark, out_dir: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/audit")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_audit(spark, out_dir: str) -> DataFrame:
    return spark.read.schema(S.AUDIT).parquet(f"{out_dir}/audit")
