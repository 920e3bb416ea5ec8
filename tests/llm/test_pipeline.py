from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline as P
from __spark_entry__ import oracle_sql, queries
from remitspark.llm import mixing, queries as Q
from tests.llm.conftest import DOCS, SF, rows_of
from tests.llm.test_minhash_dedup import brute


def test_registered():
    names = queries()
    assert {name.split("_")[0] for name in names if name.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert names["pipeline"].__wrapped__ is P.run and set(Q.QUERIES) <= set(names)
    assert set(Q.ORACLE_SQL) <= set(oracle_sql()) and "pipeline" not in oracle_sql()


def test_stages_in_order(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs)
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(d.columns == columns for d in seen[:-1])
    good, lines, single, mixed, packed = seen
    assert 0 < good.count() < 200 and lines.count() == good.count()
    assert {i: len(t) for i, t in rows_of(lines, "doc_id", "text")} == dict(rows_of(lines, "doc_id", "n_chars"))
    want = brute(rows_of(lines, "doc_id", "text"), P.SHINGLE_WORDS)
    assert sorted(r[0] for r in rows_of(single, "doc_id")) == sorted(d for d, _, c in want if d == c)
    taken = defaultdict(int)
    for doc_id, text in rows_of(mixed, "doc_id", "text"):
        taken[doc_id] += len(P.WORDS.findall(text))
    for r in mixing.mix_sources(single).collect():
        assert taken[r.doc_id] == r.taken
    by_doc = Counter()
    for doc_id, length in rows_of(packed, "doc_id", "length"):
        by_doc[doc_id] += length
    assert set(by_doc) == {r[0] for r in rows_of(mixed, "doc_id")}
    assert sorted(rows_of(P.run(spark, SF), "doc_id", "length"), key=str) == sorted(rows_of(packed, "doc_id", "length"), key=str)


def test_stages_pass_odd_rows(spark, odd_docs, no_docs):
    for name, stage in P.STAGES:
        assert stage(spark, no_docs, SF).collect() == []
        found = stage(spark, odd_docs, SF)
        assert found.count() > 0, name
        if name != P.STAGES[-1][0]:
            assert found.columns == odd_docs.columns


def test_repeated_rows_are_copies(spark):
    rows = [(1, "a b c d e f g", "en", "s", 13)] * 3 + [(2, "A b c d e f g", "en", "s", 13), (None, "a b", "en", "s", 3), (None, "a b", "en", "s", 3)]
    docs = spark.createDataFrame(rows, DOCS)
    got = [(r.doc_id, r.text) for r in P.near_copy_stage(spark, docs, SF).collect()]
    assert sorted(got, key=str) == [(1, "a b c d e f g"), (None, "a b")]
    mixed = P.mixing_stage(spark, docs, SF).collect()
    assert sum(len(P.WORDS.findall(r.text)) for r in mixed) == 48  # 150 % of 32 words


def test_one_row_of_each_group_of_near_copies(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    a, b, c, d, e = map(text, "abcde")
    rows = [
        (1, a), (5, f"{a} more"), (5, b),  # id 5 stays for b alone
        (2, c), (None, c), (None, f"{c} more"),  # copies without an id
        (None, d), (None, f"{d} more"),  # a group without any id
        (7, e), (7, f"{e} more"), (7, f"{e} more"),  # near copies of one id
        (8, None), (8, None), (None, None), (9, ""), (10, ""),  # without words
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    got = [(r.doc_id, r.text and r.text.removesuffix(" more")) for r in P.near_copy_stage(spark, docs, SF).collect()]
    want = [(1, a), (5, b), (2, c), (None, d), (7, e), (8, None), (None, None), (9, ""), (10, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
