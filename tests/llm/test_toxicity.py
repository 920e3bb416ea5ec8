from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitspark.llm import toxicity as X
from remitspark.llm.queries import QUERIES
from tests.llm.conftest import DOCS, with_clashes

LABELS = "doc_id long, toxic int"


@pytest.mark.parametrize("seed", range(4))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    moves = rng.normal(size=(2, 2))
    moves[0, 0] = 0
    sizes = np.array([1, 4, 6])
    emission = rng.normal(size=(3, 6)) * (np.arange(6) < sizes[:, None])
    forward, backward = X.messages(emission, sizes, moves)
    for k, n in enumerate(sizes):
        weight = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            total = sum(e * y for e, y in zip(emission[k], labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:]))
            weight[labels] = np.exp(total)
        for t in range(n):
            want = sum(w for y, w in weight.items() if y[t]) / sum(weight.values())
            assert 1 / (1 + np.exp(-(forward + backward)[k, t])) == pytest.approx(want)


def test_plain_lines_by_length():
    model = X.Field(np.zeros(0, np.uint64), np.zeros(0), -4.0, np.array([[0, -1.0], [0.5, 2.0]]))
    largest, total = X._plain(model, 700)
    for n in (1, 2, 100, 256, 257, 700):
        forward, backward = X.messages(np.full((1, n), -4.0), np.array([n]), model.moves)
        chance = 1 / (1 + np.exp(-(forward + backward)[0]))
        assert total[n] == pytest.approx(chance.sum(), rel=1e-6)
        assert largest[n] == pytest.approx(chance.max(), rel=1e-9)


def corpus(n=600):
    rng = np.random.default_rng(3)
    plain = [f"w{k}a" for k in range(60)]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, 30))
        toxic = i % 5 == 0
        if toxic:
            at = int(rng.integers(0, 28))
            words[at : at + 2] = rng.choice(["Vile", "sludge", "grumbo" + "xyzuv"[i % 5] * (i % 3 + 1)], 2)
        rows.append((i, " ".join(words[:15]) + ".\n" + " ".join(words[15:]), "en", "s", 1))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents_and_spans(spark):
    rows, labels = corpus()
    rows += [(9000, None, None, None, None), (9001, "", "en", "s", 0), (None, "Vile", "en", "s", 1), (9002, "é " * 30000 + "sludge VILE!", "en", "s", 1)]
    rows += [(9003, "vile", "en", "s", 1)] * 2
    docs = with_clashes(spark.createDataFrame(rows, DOCS).repartition(3)).drop("toxic", "held_out")
    found = X.score(docs, with_clashes(spark.createDataFrame([*labels, (None, 1), (1, None)], LABELS))).collect()
    assert len(found) == len(rows)
    truth = dict(labels)
    for r in found:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    by_id = {r.doc_id: r for r in found}
    assert by_id[9000].score == by_id[9001].score and by_id[9000].predicted == 0 and by_id[9000].spans == []
    assert [(s.start, s.stop) for s in by_id[9002].spans] == [(60000, 60011)]
    assert by_id[9003].predicted == 1 and not by_id[None].held_out


def test_without_labels_of_both_kinds(spark, no_docs):
    rows, _ = corpus(20)
    docs = spark.createDataFrame(rows, DOCS)
    for labels in ([], [(1, 1), (3, 1)], [(1, 0)]):
        found = X.score(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(found) == 20 and {r.score for r in found} == {0.0}
    assert X.score(no_docs, spark.createDataFrame([(1, 1), (3, 0)], LABELS)).collect() == []


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, DOCS)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    one, two = (X.score(docs, spark.createDataFrame(x, LABELS)).select("doc_id", "score").collect() for x in (labels, flipped))
    assert dict(map(tuple, one)) == dict(map(tuple, two))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op6_toxic_spans"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    wrong = found.filter((F.col("toxic") == 0) & (F.col("predicted") == 1)).count()
    right = found.filter((F.col("toxic") == 1) & (F.col("predicted") == 1)).count()
    assert right > 5 * wrong and right > 0.5 * found.filter("toxic = 1").count()
