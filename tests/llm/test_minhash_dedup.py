from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from remitspark.llm import components as C, minhash_dedup as M
from tests.llm.conftest import DOCS, SF, rows_of


def shingles(text, words):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if 0 < len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + words]) for k in range(len(found) - words + 1))


def brute(rows, words):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders, linked = defaultdict(list), [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for i in linked:
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in linked:
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    group = set(linked)
    return [(rows[i][0], len(sets[i]), least[find(i)] if i in group else rows[i][0]) for i in range(len(rows))]


def got(found):
    rows = found.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("words", [1, 2, 5])
def test_odd_rows(spark, odd_docs, words):
    want = sorted(brute(rows_of(odd_docs, "doc_id", "text"), words), key=str)
    assert got(M.near_duplicates(odd_docs, words=words)) == want


@pytest.mark.parametrize("run_rows, block, leaders", [(100_000, 16 << 20, 16), (5, 20_000, 1), (5, 5_000, 3)])
def test_chains_and_groups_of_near_copies(spark, monkeypatch, run_rows, block, leaders):
    """Copies of copies, of which the ends are unlike; long runs in parts; families in blocks."""
    monkeypatch.setattr(M, "RUN_ROWS", run_rows)
    monkeypatch.setattr(M, "BLOCK_BYTES", block)
    monkeypatch.setattr(M, "LEADERS", leaders)
    rnd = random.Random(11)
    rows = []
    for group in range(6):
        words = [f"g{group}w{rnd.randint(0, 300)}" for _ in range(120)]
        for _ in range(25):
            rows.append((len(rows), " ".join(words), "en", "s", 1))
            words = list(words)
            for _ in range(rnd.choice([1, 3, 6])):
                words[rnd.randrange(120)] = f"n{rnd.randint(0, 9999)}"
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert got(M.near_duplicates(docs, words=2)) == sorted(brute([r[:2] for r in rows], 2), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(M.near_duplicates(docs, words=2)) == sorted(brute(rows_of(docs, "doc_id", "text"), 2), key=str)


def test_no_documents(spark, no_docs):
    assert M.near_duplicates(no_docs, words=2).collect() == []


def test_chance_to_share_no_table():
    """Minhashes of sets of similarity 0.8 agree with that probability."""
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(3000):
        one = rng.integers(0, 1 << 32, M.HASHES, dtype=np.uint32)
        two = np.where(rng.random(M.HASHES) < 0.8, one, rng.integers(0, 1 << 32, M.HASHES, dtype=np.uint32))
        keys = M.table_keys(np.stack([one, two]))
        alike = M.agreeing(*[tuple(b[k : k + 1] for b in M.bits(np.stack([one, two]))) for k in (0, 1)])[0] >= M.ALIKE
        missed += not (keys[0] == keys[1]).any() or not alike
    assert missed <= 12
    assert keys.shape == (2, 9 * 12)


@pytest.mark.parametrize("seed, task_links", [(0, 1 << 19), (1, 7), (2, 1)])
def test_components(spark, monkeypatch, seed, task_links):
    monkeypatch.setattr(C, "TASK_LINKS", task_links)
    rnd = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 40)] + [(rnd.randint(100, 200), rnd.randint(100, 200)) for _ in range(60)] + [(300, 301), (301, 300), (5, 5)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    found = {r.node: r.root for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root if any(x in link and link[0] != link[1] for link in links)}
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []
