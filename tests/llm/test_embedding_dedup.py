from __future__ import annotations

import numpy as np
import pytest

from remitspark.llm import embedding_dedup as E
from tests.llm.conftest import SF, with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Links counted and components, with vectors compared one block at a time."""
    good = [i for i, (v, x, _) in enumerate(rows) if v is not None and x and all(y is not None and np.isfinite(y) for y in x) and any(x)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and len(x) == len(y) and x @ y / np.sqrt(x @ x * (y @ y)) >= 0.9:
                links[a] += 1
                links[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i in good:
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], least[find(i)] if i in set(good) else rows[i][0]) for i in range(len(rows))]


def sample(seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 16)).astype("f4")
    rows = [(i, (base[i % 40] + 0.12 * (i >= 40) * rng.normal(size=16)).astype("f4").tolist(), i % 3) for i in range(150)]
    rows += [(200 + i, base[0].tolist(), 0) for i in range(20)] + [(300, (base[0] * 7).tolist(), 0), (300, base[1].tolist(), 0)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [float("nan")] + [1.0] * 15, 0), (404, [None] + [1.0] * 15, 0)]
    rows += [(405, [float("inf")] + [1.0] * 15, 0), (None, base[0].tolist(), 0), (406, [1.0, 0.0], 0), (407, [1.0, 0.1], 0), (408, [1e38] * 16, 0), (409, [2e38] * 16, 0)]
    return rows


def test_equals_brute_force(spark):
    rows = sample()
    found = E.near_vectors(with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(3), recall=0.99999).collect()
    want = brute(rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == sorted(want, key=str)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_recall_and_no_false_links(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(300, 32))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    turned = 0.905 * base + np.sqrt(1 - 0.905**2) * side  # pairs just above the threshold
    rows = [(i, x.tolist(), 0) for i, x in enumerate(np.concatenate([base, turned]))]
    got = {r.vec_id: r.n_links for r in E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert sum(got[i] for i in range(300)) >= 0.9 * 300
    assert max(got.values()) <= max(n for _, n, _ in brute(rows))


def test_plan_grows_slowly():
    entries = [E.plan(n)[1] for n in (100, 10_000, 10**6, 10**8)]
    assert entries == sorted(entries) and entries[-1] < 400


def test_no_vectors(spark):
    assert E.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    bad = E.near_vectors(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in bad] == [(1, 0, 1, True)]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T) >= 0.9).sum() - len(x)
    got = sum(r.n_links for r in E.near_vectors(spark.read.parquet(f"{SF}/embeddings.parquet")).collect())
    assert 0.9 * want <= got <= want
