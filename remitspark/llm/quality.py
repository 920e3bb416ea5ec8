"""Quality by importance resampling towards labelled good text.

Two generative models of hashed n-grams are counted: one of the target, documents labelled
good, one of the raw text of all documents. A document's log weight is the mean of the log
ratios of its n-grams, taken ``LENGTH`` times, as if all documents were of that length. Gumbel
noise on the log weights and the largest k of the sums are a sample of k documents without
replacement, with these weights. k is the number of documents whose ratio is on the good side
of the split that tells labelled good from labelled poor documents best.

N-grams are runs of four bytes, and for neighbouring words whether they are the same word.
Target model and split are fitted on at most ``LABELLED`` labelled documents of each kind, drawn
by a hash; the raw model and the sample cover all rows. The noise is a hash of id and text, so
reruns agree.

Defined results: a null or empty text has ratio 0 and competes with that. Null labels don't
count; a document with both labels is poor. Without labels of both kinds every document is
kept. Rows of one id and text stand or fall together, also when that takes the sample
over k. An empty table gives no rows. Other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from remitspark.llm.common import stored
from remitspark.llm.textarrays import BASE, Hasher, mix, slices, text_bytes, word_bounds

BINS = 1 << 16
GRAM = 4
LENGTH = 400
#: Labelled documents of each kind that the target model and the split are fitted on, at most.
LABELLED = 10_000
#: Weights are compared in millionths.
UNIT = 1_000_000
STEP = 1 << 16


def grams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bins and rows of all n-grams of a batch."""
    data, offsets = text_bytes(batch.column("text"))
    hashes = Hasher(data, lower=False)
    row_of_byte = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(offsets))
    at = np.flatnonzero(row_of_byte[GRAM - 1 :] == row_of_byte[: len(data) - GRAM + 1]) if len(data) >= GRAM else np.zeros(0, np.int64)
    start, end, row = word_bounds(data, offsets)
    words = hashes(start, end)
    pair = np.flatnonzero(row[1:] == row[:-1])
    same = mix((words[1:] == words[:-1]).astype(np.uint64) + BASE)
    values = np.concatenate([hashes(at, at + GRAM), same[pair]])
    return (values % np.uint64(BINS)).astype(np.uint16), np.concatenate([row_of_byte[at], row[pair]])


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """At most ``LABELLED`` rows (label_id, good) of each kind."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("label_id")).agg((F.min(label_col) == 1).alias("good"))
    drawn = known.orderBy(F.xxhash64("label_id"))
    return stored(drawn.filter("good").limit(LABELLED).unionByName(drawn.filter("NOT good").limit(LABELLED)), "labelled")


def log_ratios(docs: DataFrame, known: DataFrame) -> np.ndarray:
    """Log of target over raw probability of every bin. ``docs`` has doc_id and text."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BINS, dtype=np.int64), np.zeros(BINS, dtype=np.int64)
        for batch in slices(batches, "text"):
            bins, rows = grams(batch)
            raw += np.bincount(bins, minlength=BINS)
            good = batch.column("good").to_numpy(zero_copy_only=False).astype(bool)
            target += np.bincount(bins[good[rows]], minlength=BINS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bin", "raw", "target"])

    # At most 2 * LABELLED ids.
    marked = docs.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"), "left")
    texts = marked.select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counts = texts.mapInArrow(count, "bin long, raw long, target long").groupBy("bin").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(BINS), np.zeros(BINS)
    for at, of_raw, of_target in counts.collect():  # one row a bin
        raw[at], target[at] = of_raw, of_target
    if not target.any():
        return np.zeros(BINS)
    return np.log((target + 1) / (target.sum() + BINS)) - np.log((raw + 1) / (raw.sum() + BINS))


def scorer(ratios: np.ndarray) -> Callable[[str], Column]:
    """A column function: mean log ratio of a text's n-grams."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        means = [np.zeros(0)]
        for batch in slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text"):
            bins, rows = grams(batch)
            sums = np.bincount(rows, weights=ratios[bins], minlength=batch.num_rows)
            means.append(sums / np.maximum(np.bincount(rows, minlength=batch.num_rows), 1))
        return pa.array(np.concatenate(means))

    return score


def split_at(ratio: np.ndarray, good: np.ndarray) -> float | None:
    """The ratio that parts good and poor with the fewest errors, each kind counted alike; None if one is missing.

    In the middle of the widest gap among such places.
    """
    if not good.any() or good.all():
        return None
    order = np.argsort(ratio, kind="stable")
    ratio, good = ratio[order], good[order]
    missed = np.append(0, np.cumsum(good)) / good.sum() + (1 - np.append(0, np.cumsum(~good)) / (~good).sum())
    edges = np.concatenate([[ratio[0]], ratio, [ratio[-1]]])
    apart = np.append(np.append(True, ratio[1:] > ratio[:-1]), True)
    best = np.flatnonzero(apart & (missed <= missed[apart].min() + 1e-12))
    widest = best[np.argmax(edges[best + 1] - edges[best])]
    return float((edges[widest] + edges[widest + 1]) / 2)


def kth_largest(values: DataFrame, column: str, k: int) -> int:
    """The k-th largest value of a column of longs, from counts in ever narrower ranges."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = -(-(high - low + 1) // STEP)
        part = values.filter(F.col(column).between(low, high))
        counts = part.groupBy(F.floor((F.col(column) - low) / width).alias("at")).count().collect()  # at most STEP rows
        for at, count in sorted(counts, reverse=True):
            if count >= k:
                low, high = low + at * width, min(high, low + (at + 1) * width - 1)
                break
            k -= count
    return low


def resample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id"
) -> DataFrame:
    """All rows as ``row`` with log_ratio, log_weight (noise included) and kept."""
    known = labelled(labels, label_id, label_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    score = scorer(log_ratios(texts, known))
    uniform = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noise = -F.log(-F.log(uniform))
    weight = F.floor((F.col("log_ratio") * LENGTH + noise) * UNIT)

    scored = stored(texts.select("doc_id", noise.alias("noise"), score("text").alias("log_ratio")), "scores")
    weighed = scored.select("doc_id", "log_ratio", F.floor((F.col("log_ratio") * LENGTH + F.col("noise")) * UNIT).alias("weight"))
    sample = weighed.join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("log_ratio", "good")
    drawn = sample.dropDuplicates().toPandas()  # of at most 2 * LABELLED documents
    split = split_at(drawn["log_ratio"].to_numpy(float), drawn["good"].to_numpy(bool))
    least = None
    if split is not None and (k := weighed.filter(F.col("log_ratio") >= split).count()):
        least = kth_largest(weighed, "weight", k)
    columns = {"doc_id": id_col, "text": text_col}
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", *[F.col("row")[name].alias(alias) for alias, name in columns.items()])
    rows = rows.withColumn("log_ratio", score("text")).withColumn("weight", weight)
    kept = F.lit(True) if least is None else F.col("weight") >= least
    return rows.select("row", "log_ratio", (F.col("weight") / UNIT).alias("log_weight"), kept.alias("kept"))
