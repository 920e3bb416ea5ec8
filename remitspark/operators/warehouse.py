"""The ``transactions`` table: definition, bulk load in one step, scan and structure.

A load writes rows to ``<table>_rows`` and the versions of files that they replace to
``<table>_superseded``, both under an id of its own, and last one file to ``<table>_loads`` that
names the load and the runs that it brings. ``<table>`` is a view of the 11 columns that
shows rows of committed loads only and leaves out what committed loads replace. So a load is
seen as a whole or not at all, and what a load that was cut off has left is never seen. Nothing
is written in place. If two loads bring the same run at once, the view shows the run once, from
the load with the smaller id.

Files are sorted by amount, each by itself and without a shuffle, and hold a Bloom filter of transaction
ids: ranges of amounts read some pages of a file, lookups of an id open the files that may have it.

The view resolves the commits before the rows: what a commit names was written before it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from remitspark import schema as S
from remitspark.operators import sinks

KINDS = ("rows", "superseded", "loads")
#: Rows of a file are sorted by one column, so that a range of it is in few pages; a Bloom filter is on the other.
SORTED, LOOKUP = "amount", "transaction_id"


def create_transactions(
    spark: SparkSession, table: str = "transactions", location: str | None = None
) -> None:
    """Creates tables and view where absent, in ``location`` or in the session's warehouse."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.TRANSACTIONS.fields)

    def create(kind: str, columns: str, partitions: str = "", options: dict[str, str] | None = None) -> None:
        place = f" LOCATION '{location}/{kind}'" if location else ""
        by = f" PARTITIONED BY ({partitions})" if partitions else ""
        given = f" OPTIONS ({', '.join(f'{k!r} = {v!r}' for k, v in options.items())})" if options else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_{kind} ({columns}) USING parquet{given}{by}{place}")

    rows = f"{columns}, source_file string, run_id string, load_id string, claim string"
    create("rows", rows, "load_id, claim", {f"parquet.bloom.filter.enabled#{LOOKUP}": "true", "parquet.bloom.filter.adaptive.enabled": "true"})
    create("superseded", "source_file string, run_id string, load_id string", "load_id")
    create("loads", "load_id string, claim string")
    spark.sql(f"CREATE VIEW IF NOT EXISTS {table} AS {_current(table, S.REQUIRED_COLUMNS)}")


def _current(table: str, columns: list[str]) -> str:
    """SQL of the rows that committed loads show."""
    return f"""SELECT {", ".join(f"r.{c}" for c in columns)}
        FROM (SELECT claim, min(load_id) AS load_id FROM {table}_loads GROUP BY claim) AS c
        JOIN {table}_rows AS r ON r.claim = c.claim AND r.load_id = c.load_id
        WHERE NOT EXISTS (
            SELECT 1 FROM {table}_superseded AS s JOIN (SELECT DISTINCT load_id FROM {table}_loads) AS l ON l.load_id = s.load_id
            WHERE s.source_file = r.source_file AND s.run_id = r.run_id)"""


def current_rows(spark: SparkSession, table: str) -> DataFrame:
    """The view's rows together with their file and run."""
    return spark.sql(_current(table, [*S.REQUIRED_COLUMNS, "source_file", "run_id"]))


def drop_transactions(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for kind in KINDS:
        spark.sql(f"DROP TABLE IF EXISTS {table}_{kind}")


def load(spark: SparkSession, out_dir: str, table: str = "transactions", mode: str = "append") -> None:
    """Adds processed rows in one step, with explicit casts to the table's types.

    ``append`` takes all current rows, each time it is called. ``incremental`` takes only
    runs that no committed load has brought, and tells the table which versions they replace.
    """
    if mode not in ("append", "incremental"):
        raise ValueError(f"mode must be 'append' or 'incremental', not {mode!r}")
    create_transactions(spark, table)
    load_id = f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
    audit, loads = sinks.read_audit(spark, out_dir), spark.table(f"{table}_loads")
    if mode == "append":
        write_rows(sinks.read_processed(spark, out_dir), table, load_id, F.lit(load_id))
        runs_here = audit.select(F.col("run_id").alias("claim")).distinct()
        commit(runs_here.union(spark.createDataFrame([(load_id,)], "claim string")), table, load_id)
        return
    fresh = new_runs(audit, loads)
    known = spark.table(f"{table}_superseded").join(loads.select("load_id").distinct(), "load_id", "left_semi")
    gone = sinks.superseded(audit).join(known, ["source_file", "run_id"], "left_anti")
    if fresh:
        write_rows(runs(sinks.all_processed(spark, out_dir), fresh), table, load_id, F.col("run_id"))
    elif gone.isEmpty():
        return
    write_superseded(gone, table, load_id)
    commit(spark.createDataFrame([(run_id,) for run_id in [load_id, *fresh]], "claim string"), table, load_id)


def write_rows(processed: DataFrame, table: str, load_id: str, claim: Column) -> None:
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRANSACTIONS.fields]
    rows = processed.select(*typed, "source_file", "run_id", F.lit(load_id).alias("load_id"), claim.alias("claim"))
    rows.sortWithinPartitions("load_id", "claim", SORTED).write.insertInto(f"{table}_rows")


def write_superseded(gone: DataFrame, table: str, load_id: str) -> None:
    gone.select("source_file", "run_id", F.lit(load_id).alias("load_id")).write.insertInto(f"{table}_superseded")


def commit(claims: DataFrame, table: str, load_id: str) -> None:
    """One file, so that all of it is there or nothing."""
    claims.select(F.lit(load_id).alias("load_id"), "claim").coalesce(1).write.insertInto(f"{table}_loads")


def new_runs(audit: DataFrame, loads: DataFrame) -> list[str]:
    """Ids of runs with valid rows that no committed load has brought: names, one per run."""
    with_rows = audit.filter("total_valid_records > 0").select("run_id").distinct()
    return [row["run_id"] for row in with_rows.join(loads, F.col("run_id") == F.col("claim"), "left_anti").collect()]


def runs(processed: DataFrame, run_ids: list[str]) -> DataFrame:
    """Rows of some runs; other directories are not read."""
    return processed.filter(F.col("run_id").isin(run_ids))


def transactions(spark: SparkSession, table: str = "transactions") -> DataFrame:
    return spark.table(table)


def describe_transactions(tx: DataFrame) -> DataFrame:
    """``column_name, data_type, ordinal_position`` of a DataFrame's columns."""
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(tx.schema.fields, start=1)]
    return tx.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, ordinal_position int"
    ).orderBy("ordinal_position")
