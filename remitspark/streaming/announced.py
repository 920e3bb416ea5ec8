"""Arrival messages as a stream: every announced version of a file is processed once.

Messages repeat, across files of the log and across restarts. Keyed state drops what has been seen
before: one entry per bucket, key and sequencer, dealt over the state's partitions. A file that is
sent again has a new sequencer and is processed again; messages without one announce their key once.
"""

from __future__ import annotations

import hashlib
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from remitspark.plans.ingest import ingest
from remitspark.session import drop_work_folder, new_work_folder
from remitspark.sources.notifications import ACCEPTED, route_notifications
from remitspark.sources.records import literal_path
from remitspark.tables import store


def announced(log: DataFrame, bucket: str) -> DataFrame:
    """``key`` of every accepted file of a streaming log with a ``json`` column, once per version."""
    accepted = route_notifications(log, bucket).filter((F.col("status") == ACCEPTED) & (F.col("bucket") == bucket))
    versions = accepted.select("bucket", "key", F.coalesce("sequencer", F.lit("")).alias("sequencer"))
    return versions.dropDuplicates(["bucket", "key", "sequencer"]).select("key")


def ingest_announced_stream(
    spark: SparkSession,
    log_dir: str,
    raw_dir: str,
    out_dir: str,
    checkpoint: str,
    bucket: str,
    max_files: int = 1000,
    partition_by: str = "file",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts the stream over a folder of files with one message a line. By default it takes what is new and stops.

    Keys are relative to ``raw_dir``, which holds the bucket. A batch that is run again has the same
    messages, so its runs have the same ids and files and replace their own output.
    """
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = new_work_folder(session, "announced")
        try:
            keys = store(batch.distinct().sort("key"), folder).sort("key")
            names = (f"{raw_dir.rstrip('/')}/{row['key']}" for row in keys.toLocalIterator())
            part = 0
            while chunk := [literal_path(name) for name in islice(names, max_files)]:
                ingest(session, raw_dir, out_dir, chunk, partition_by, f"{stream_id}-{batch_id:08d}-{part:06d}")
                part += 1
        finally:
            drop_work_folder(session, folder)

    log = spark.readStream.text(log_dir).withColumnRenamed("value", "json")
    return (
        announced(log, bucket)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
