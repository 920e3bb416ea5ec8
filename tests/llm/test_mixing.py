from __future__ import annotations

import re
from collections import defaultdict

import pytest

from remitspark.llm import mixing
from tests.llm.conftest import DOCS, rows_of


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = share * total - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        level = left / free if free else 0.0
        above = {s for s in order if s not in full and level * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in order}
        full |= above


def check(rows, found):
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += count(text)
    want = targets(dict(sizes))
    got = found.collect()
    assert sorted(((r.doc_id, r.size, r.source) for r in got), key=str) == sorted(((d, count(t), s) for d, t, s in rows), key=str)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1
        partial = [r for r in got if r.source == source and r.size and r.taken % r.size]
        assert len(partial) <= 1
    return got


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_every_source_takes_its_target(odd_docs, bucket_rows):
    check(rows_of(odd_docs, "doc_id", "text", "source"), mixing.mix_sources(odd_docs, bucket_rows=bucket_rows))


def test_hot_source_and_small_ones(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "s" if i % 3 else f"s{i}", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    check([(r[0], r[1], r[3]) for r in rows], mixing.mix_sources(docs, bucket_rows=50))


def test_reruns_and_partitions_agree(odd_docs):
    def run(docs):
        return sorted(rows_of(mixing.mix_sources(docs, bucket_rows=10), "doc_id", "source", "size", "taken"), key=str)

    assert run(odd_docs) == run(odd_docs) == run(odd_docs.repartition(7))


def test_copies_are_unbiased(spark):
    """Every document is taken with its fractional copies on average."""
    rows = [(i, "w " * (1 + i % 5), "en", "ab"[i % 2], 1) for i in range(200)]
    shares = []
    for k in range(12):
        docs = spark.createDataFrame([(r[0] + 1000 * k, *r[1:]) for r in rows], DOCS)
        got = mixing.mix_sources(docs).collect()
        shares.append(sum(r.taken // r.size for r in got if r.size == 3) / sum(r.target / r.source_size for r in got if r.size == 3))
    assert sum(shares) / len(shares) == pytest.approx(1, abs=0.05)


def test_no_documents_and_no_words(spark, no_docs):
    assert mixing.mix_sources(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", None, 0)], DOCS)
    assert [(r.target, r.taken) for r in mixing.mix_sources(blank).collect()] == [(0.0, 0), (0.0, 0)]
