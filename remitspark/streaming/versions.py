"""Versions of CSV files as a stream: a file that is sent again under its name is processed again.

A version is a file's name, modification time and length. Each micro-batch lists the folder in
tasks, leaves out the versions that the table ``seen`` beside the checkpoint names, and runs the
ingest on the others, so many at a time. A version is added to ``seen`` after its ingest. After a
failure in between it is processed once more under a later run, which replaces the earlier one.
Hidden names and files without a byte are versions like all others and get their audit rows.

The stream's offsets are times of listings, so its checkpoint has the same size whatever the
number of files is. A file sent again with the same time and length is not told apart.
"""

from __future__ import annotations

import hashlib
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from remitspark.functions.naming import is_csv
from remitspark.plans.ingest import ingest
from remitspark.session import drop_work_folder, new_work_folder
from remitspark.sources.records import literal_path
from remitspark.sources.walk import walk

SEEN = "name string, modified long, length long"


def _listing_times() -> type[DataSource]:
    """A streaming source of one row per trigger: when to list. Defined here, so that workers need no import."""

    class Reader(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"at": 0}

        def latestOffset(self) -> dict:
            import time

            return {"at": time.time_ns()}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            return [InputPartition(end["at"])]

        def read(self, partition: InputPartition):
            yield (partition.value,)

    class ListingTimes(DataSource):
        @classmethod
        def name(cls) -> str:
            return "listing_times"

        def schema(self) -> str:
            return "at long"

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Reader()

    return ListingTimes


def seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Versions that have been processed."""
    folder = f"{checkpoint.rstrip('/')}-seen"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SEEN)
    return spark.read.schema(SEEN).parquet(folder)


def new_versions(spark: SparkSession, raw_dir: str, checkpoint: str, folder: str) -> DataFrame:
    """Versions of admitted files below ``raw_dir`` that have not been processed."""
    found = walk(spark, raw_dir, folder).filter(is_csv(F.col("name")))
    return found.join(seen(spark, checkpoint), ["name", "modified", "length"], "left_anti")


def ingest_versions(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint: str,
    max_files: int = 1000,
    partition_by: str = "file",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts the stream. By default it takes what is new or changed, and stops."""
    spark.dataSource.register(_listing_times())
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = new_work_folder(session, "versions")
        try:
            todo = f"{folder}/todo"
            new_versions(session, raw_dir, checkpoint, folder).sort("name").write.parquet(todo)
            rows = session.read.schema(SEEN).parquet(todo).sort("name").toLocalIterator()
            while chunk := list(islice(rows, max_files)):
                paths = [literal_path(f"{raw_dir.rstrip('/')}/{row['name']}") for row in chunk]
                # Named after its files: a run never replaces the output of other files.
                digest = hashlib.sha256("\n".join(f"{r['name']}\t{r['modified']}\t{r['length']}" for r in chunk).encode())
                ingest(session, raw_dir, out_dir, paths, partition_by, f"{stream_id}-{batch_id:08d}-{digest.hexdigest()[:12]}")
                done = session.createDataFrame([tuple(row) for row in chunk], SEEN)
                done.coalesce(1).write.mode("append").parquet(f"{checkpoint.rstrip('/')}-seen")
        finally:
            drop_work_folder(session, folder)

    return (
        spark.readStream.format("listing_times")
        .load()
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
