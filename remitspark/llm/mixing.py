"""Mixing of sources to target weights by pivotal dependent rounding.

Every source has a target of words; its documents get fractional copies, target by size of the
source. Whole copies are decided by pairing documents: words move from one to the other until
the copies of one are whole, in a random direction that leaves every document's expected copies
as they were. The sum of a source's words does not change in a pairing. So each bucket of rows
leaves one undecided document per source, and these are paired again, bucket by bucket, up a
tree. The last one of a source takes the part of its words that is left.

Buckets and random numbers come from hashes of ids, so the same rows give the same mix however
they are partitioned.

Defined results: a null or empty text has size 0 and takes 0 words. Null is a source of its own
and comes last. Null ids stay null; rows that share an id are rows of their own. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from remitspark.llm.common import arrow_schema, stored
from remitspark.llm.textarrays import BASE, mix, unit_floats

#: Weights of the sources in order, repeating; share of all words taken; most copies of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 20_000
FAN_IN = 64
#: What a word is, and how the order of code points is told from that of bytes.
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Rows (doc_id, source, size, salt); the salt tells rows with one id apart."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("source", docs.schema[source_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("size", "salt")]
    )
    arrow = arrow_schema(schema)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.count_substring_regex(batch.column("text").fill_null(""), WORD).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), sizes, batch.column("salt")], schema=arrow)

    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.col(text_col).alias("text"),
        F.xxhash64(id_col, source_col, text_col).alias("salt"),
    )
    return texts.mapInArrow(count, schema)


def ranked(sources: DataFrame) -> DataFrame:
    """Stored sources with their place in the order of code points, null last, from 0.

    Ranges of sources are numbered side by side; only the number of sources in each range,
    one value per partition, goes through the driver.
    """
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "sources")
    counts = sorted((r["part"], r["count"]) for r in ranged.groupBy("part").count().collect())
    before = list(accumulate((count for _, count in counts), initial=0))
    starts = [(part, start) for (part, _), start in zip(counts, before, strict=False)]
    started = ranged.join(F.broadcast(sources.sparkSession.createDataFrame(starts, "part int, before long")), "part")
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return started.withColumn("place", place - 1 + F.col("before")).drop("part", "before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Stored rows (source, source_size, target).

    Words are shared out by weight. A source stops at ``most`` times its size, and what it can't
    take is shared out again among the others, until none is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = ranked(sources)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = stored(rows.withColumn("weight", weight), "weighted")
    level, full = 0.0, F.lit(False)
    total = rows.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    while True:
        left = rows.agg(
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0.0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(full.cast("long")).alias("n"),
        ).first()
        if not left["weight"]:
            break
        level = (share * total - left["held"]) / left["weight"]
        above = full | (level * F.col("weight") > most * F.col("source_size"))
        if rows.agg(F.sum(above.cast("long")).alias("n")).first()["n"] == left["n"]:
            break
        full = level * F.col("weight") > most * F.col("source_size")
    target = F.when(full, most * F.col("source_size")).otherwise(level * F.col("weight"))
    return stored(rows.select("source", "source_size", target.cast("double").alias("target")), "targets")


def _pivot(source: np.ndarray, copies: np.ndarray, size: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rounds the copies of rows that are ordered by source, pair by pair.

    Returns the copies, and for every row whether it is still undecided: one a source at most.
    """
    whole = np.floor(copies)
    part, open_ = copies - whole, np.zeros(len(copies), dtype=bool)
    held = -1
    for i in np.flatnonzero((part > 1e-12) & (size > 0)):
        if held >= 0 and source[held] != source[i]:
            open_[held] = True
            held = -1
        if held < 0:
            held = i
            continue
        # Words that may move up to `held` until one of the two is whole, and down from it.
        up = min((1 - part[held]) * size[held], part[i] * size[i])
        down = min(part[held] * size[held], (1 - part[i]) * size[i])
        words = up if chance[i] * (up + down) < down else -down
        part[held] += words / size[held]
        part[i] -= words / size[i]
        settled = [k for k in (held, i) if part[k] < 1e-9 or part[k] > 1 - 1e-9]
        for k in settled:
            part[k] = round(part[k])
        undecided = [k for k in (held, i) if k not in settled]
        held = undecided[0] if undecided else -1
    if held >= 0:
        open_[held] = True
    return whole + part, open_


def _round(rows: DataFrame, bucket: Column, salt: int) -> DataFrame:
    """One level of the tree: rounds the undecided copies of every bucket and source."""
    schema = rows.schema
    arrow = arrow_schema(schema)

    def rounded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None  # the undecided row of the last bucket and source

        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([waiting, table]) if waiting else table
            hashed = table.column("group").to_numpy()
            group = np.cumsum(np.concatenate([[0], (hashed[1:] != hashed[:-1]).astype(np.int64)]))
            chance = unit_floats(mix(table.column("salt").to_numpy().view(np.uint64) + np.uint64(salt) * BASE))
            copies, open_ = _pivot(group, table.column("copies").to_numpy(), table.column("size").to_numpy(), chance)
            state = table.set_column(table.column_names.index("copies"), "copies", pa.array(copies))
            state = state.set_column(state.column_names.index("is_open"), "is_open", pa.array(open_))
            state = state.cast(wide)
            last = np.flatnonzero(open_ & (group == group[-1]))
            waiting = state.take(pa.array(last)) if len(last) else None
            rest = state.take(pa.array(np.setdiff1d(np.arange(len(copies)), last))).select(arrow.names)
            yield from rest.to_batches()
        if waiting:
            yield from waiting.select(arrow.names).to_batches()

    grouped = rows.withColumn("bucket", bucket).withColumn("group", F.xxhash64("bucket", "source"))
    ordered = grouped.repartition("bucket").sortWithinPartitions("bucket", "group", F.col("size").desc(), "salt").drop("bucket")
    wide = arrow_schema(ordered.schema)
    return ordered.mapInArrow(rounded, schema)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken, salt."""
    sizes = stored(sized(docs, id_col, text_col, source_col), "sizes")
    goals = targets(sizes, weights, share, most).withColumnRenamed("source", "of_source")
    goals = goals.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rows = sizes.join(goals, sizes["source"].eqNullSafe(goals["of_source"])).drop("of_source")
    rows = rows.withColumn("copies", F.col("rate")).withColumn("is_open", F.lit(True)).drop("rate")
    count = sizes.count()
    decided, buckets, level = [], max(1, -(-count // bucket_rows)), 0
    while True:
        bucket = F.pmod(F.xxhash64("salt", F.lit(level)), F.lit(buckets))
        rows = stored(_round(rows, bucket, level), "rounded")
        if buckets == 1:
            break
        decided.append(rows.filter("NOT is_open"))
        rows, buckets, level = rows.filter("is_open"), -(-buckets // FAN_IN), level + 1
    decided.append(rows)
    found = decided[0]
    for more in decided[1:]:
        found = found.unionByName(more)
    # A source's last document takes the part of its words that is left.
    taken = F.round(F.col("copies") * F.col("size")).cast("long")
    return found.withColumn("taken", taken).select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "salt")
