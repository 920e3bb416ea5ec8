from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from remitspark import tables


@pytest.mark.parametrize("limit, share", [("10MB", 10_000), ("-1", 10_000), ("-1", 4), ("-1", 0)])
def test_lookup_is_a_left_join(spark, conf, monkeypatch, tmp_path, limit, share):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    monkeypatch.setattr(tables, "HEAVY_SHARE", share)
    keys = ["hot"] * 60 + [f"k{i % 9}" for i in range(40)] + ["absent"] * 5
    rows = spark.createDataFrame([(f"f{i % 2}", k, i) for i, k in enumerate(keys)], "f string, k string, i int")
    table = tables.store(
        rows.filter("k <> 'absent'")
        .groupBy("f", "k")
        .agg(F.max("i").alias("top"), F.count("*").alias("n"), F.array(F.min("i")).alias("low")),
        str(tmp_path / "t"),
    )
    got = tables.lookup(rows, table, ["f", "k"], "n", F.col("i"))
    want = rows.join(table.drop("n"), ["f", "k"], "left")
    assert sorted(map(tuple, got.select("f", "k", "i", "top", "low").collect())) == sorted(
        map(tuple, want.select("f", "k", "i", "top", "low").collect())
    )


def test_a_hot_key_is_spread_without_adaptive_execution(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    rows = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 9973)).alias("k"), "id"
    )
    table = tables.store(
        rows.groupBy("k").agg(F.min("id").alias("first"), F.count("*").alias("n")), str(tmp_path / "t")
    )
    joined = tables.lookup(rows, table, ["k"], "n", F.col("id"))
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 1.2 * min(sizes)
    assert joined.filter(F.col("first").isNull()).count() == 0


def test_size_check(spark, conf, tmp_path):
    table = tables.store(spark.range(1000).select(F.col("id").cast("string").alias("k"), "id"), str(tmp_path / "t"))
    conf("spark.sql.autoBroadcastJoinThreshold", "20KB")
    assert not tables.fits_broadcast(table)
    conf("spark.sql.autoBroadcastJoinThreshold", "1MB")
    assert tables.fits_broadcast(table)


@pytest.mark.parametrize("words", [1 << 18, 2])
def test_only_rows_that_may_match_are_shuffled(spark, conf, monkeypatch, words):
    monkeypatch.setattr(tables, "BITMAP_WORDS", words)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.range(5000).select(F.lit("f").alias("file"), F.concat(F.lit("k"), F.col("id")).alias("key"), "id")
    table = spark.range(0, 5000, 500).select(
        F.lit("f").alias("file"), F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") * 2).alias("value"), F.lit(1).alias("n")
    )
    may, never = tables.without_match(rows, table, ["file", "key"])
    assert may.count() + never.count() == 5000
    assert never.join(table, ["file", "key"]).isEmpty()
    if words > 2:
        assert may.count() < 20
    found = tables.lookup(rows, table, ["file", "key"], "n", F.col("id"), sparse=True)
    assert found.columns == ["file", "key", "id", "value"]
    got = {r.id: r.value for r in found.collect()}
    assert got == {i: 2 * i if i % 500 == 0 else None for i in range(5000)}
