from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitspark.llm import quality
from remitspark.llm.queries import QUERIES
from tests.llm.conftest import DOCS, SF, rows_of, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def brute_ratios(texts, good):
    """Mean log ratio of every text, one n-gram at a time."""
    raw, target = np.zeros(quality.BINS), np.zeros(quality.BINS)
    import pyarrow as pa

    binned = []
    for text, is_good in zip(texts, good):
        bins, _ = quality.grams(pa.RecordBatch.from_pydict({"text": pa.array([text])}))
        data = (text or "").encode()
        words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        assert len(bins) == max(0, len(data) - 3) + max(0, len(words) - 1)
        binned.append(bins)
        for k in bins:
            raw[k] += 1
            target[k] += is_good
    ratios = np.log((target + 1) / (target.sum() + quality.BINS)) - np.log((raw + 1) / (raw.sum() + quality.BINS))
    return [ratios[b].mean() if len(b) else 0.0 for b in binned]


def test_ratios_and_sample(spark, odd_docs):
    rows = rows_of(odd_docs, "doc_id", "text")
    labels = [(i, 1 if i < 30 else 0, None) for i in range(0, 60, 2)] + [(None, 1, 1), (2, 0, 0), (7, None, None), (9999, 1, 0)]
    good = {i for i in range(0, 30, 2)} - {2}
    found = quality.resample(odd_docs, with_clashes(spark.createDataFrame(labels, LABELS))).collect()
    assert len(found) == len(rows)
    want = brute_ratios([t for _, t in rows], [d in good for d, _ in rows])
    by_row = sorted(zip((str(r) for r in rows), want))
    got = sorted((str((r.row.doc_id, r.row.text)), r.log_ratio) for r in found)
    assert [g[1] for g in got] == pytest.approx([w[1] for w in by_row])
    kept, rest = [r.log_weight for r in found if r.kept], [r.log_weight for r in found if not r.kept]
    assert kept and rest and min(kept) > max(rest)
    again = quality.resample(odd_docs.repartition(5), with_clashes(spark.createDataFrame(labels, LABELS)))
    assert sorted(str((r.row.doc_id, r.kept)) for r in again.collect()) == sorted(str((r.row.doc_id, r.kept)) for r in found)


def test_labels_of_one_kind_or_none(spark, odd_docs, no_docs):
    for labels in ([], [(1, 1, 0)], [(1, 0, 0)], [(None, 1, 1)]):
        found = quality.resample(odd_docs, spark.createDataFrame(labels, LABELS))
        assert found.filter("NOT kept").isEmpty()
        assert found.select("row.*").columns == odd_docs.columns
    assert quality.resample(no_docs, spark.createDataFrame([(1, 1, 0), (2, 0, 0)], LABELS)).collect() == []


def test_split():
    assert quality.split_at(np.array([1.0, 2, 8, 9]), np.array([False, False, True, True])) == 5
    assert quality.split_at(np.array([1.0, 8, 2, 9]), np.array([False, False, True, True])) in (1.5, 8.5)
    assert quality.split_at(np.array([1.0]), np.array([True])) is None


@pytest.mark.parametrize("step", [2, 5, 1 << 16])
def test_kth_largest(spark, monkeypatch, step):
    monkeypatch.setattr(quality, "STEP", step)
    values = [-7, -7, -3, 0, 0, 0, 5, 9, 1 << 40]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        assert quality.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_gumbel_noise_draws_by_weight(spark):
    """Of two documents with weights 3 to 1, the first is the largest three times in four."""
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    uniform = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = docs.select((F.col("doc_id") % 2).alias("kind"), (F.floor(F.col("doc_id") / 2)).alias("pair"), (-F.log(-F.log(uniform))).alias("noise"))
    best = keyed.withColumn("key", F.col("noise") + F.when(F.col("kind") == 0, np.log(3.0)).otherwise(0.0)).groupBy("pair").agg(F.max_by("kind", "key").alias("kind"))
    assert best.filter("kind = 0").count() / 10000 == pytest.approx(0.75, abs=0.02)


def test_good_documents_stay_and_poor_ones_go(spark):
    found = QUERIES["op3_quality_resampling"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    shares = {r.quality: r.share for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.97 and shares[0] < 0.2
