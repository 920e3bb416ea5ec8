"""New CSV files as a stream of paths; each micro-batch runs the ingest on its files.

A file lies wholly inside one micro-batch and all state is per file, so the stream keeps
no state of its own besides the list of files it has seen.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from remitspark.plans.ingest import ingest
from remitspark.sources.records import literal_path

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, raw_dir: str, max_files: int = 1000) -> DataFrame:
    """Streaming ``path`` of every admitted file. Contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(raw_dir)
        .select("path")
    )


def ingest_stream(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint: str,
    max_files: int = 1000,
    partition_by: str = "file",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts the ingest stream. By default it takes what is there and stops.

    A batch that is run again after a failure has the same files and the same run id, so
    it replaces its own output.
    """
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def run(batch: DataFrame, batch_id: int) -> None:
        # At most max_files names.
        paths = [literal_path(row.path) for row in batch.collect()]
        if paths:
            ingest(batch.sparkSession, raw_dir, out_dir, paths, partition_by, f"{stream_id}-{batch_id:08d}")

    return (
        arrivals(spark, raw_dir, max_files)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
