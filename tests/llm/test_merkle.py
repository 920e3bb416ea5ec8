from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from remitspark.llm import merkle
from remitspark.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import DOCS, SF, rows_of

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root, and per node the digests before and after it on the way."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, way in enumerate(ways):
            run = at[k] // 8 * 8
            way.append((nodes[run : at[k]], nodes[at[k] + 1 : run + 8]))
            at[k] //= 8
        nodes = [sha(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0], ways


def brute(rows, hit=lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {name: climb([g[2] for g in sorted(groups[name], key=lambda g: g[:3])]) for name in names}
    root, tops = climb([trees[name][0] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        for (_, _, own, row), way in zip(sorted(groups[name], key=lambda g: g[:3]), trees[name][1], strict=True):
            text = row[4]
            if text is not None and hit(row[0]):
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded, proof = leaf((*row[:4], text)), ""
            for before, after in [*way, *top]:
                folded = sha(*before, folded, *after)
                proof += "".join([*before, *after])
            out.append((row[0], own, trees[name][0], root, sha(proof), folded, folded == root))
    return sorted(out, key=str)


def altered():
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return {"text": F.when(hit, merkle.lowered(F.col("text"))).otherwise(F.col("text"))}


def found(docs, levels=4):
    return sorted(map(tuple, merkle.manifest(docs, altered=altered(), levels=levels).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 4])
def test_odd_rows(spark, odd_docs, no_docs, levels):
    assert found(odd_docs, levels) == brute(rows_of(odd_docs, *FIELDS))
    assert found(no_docs, levels) == []


def test_sizes_of_groups_many_tiers_and_tasks(spark, monkeypatch):
    """Groups of 1 to 600 rows, among them those where a run or a level has one node; three tiers of superblocks."""
    monkeypatch.setattr(merkle, "TASK_LEAVES", 100)
    rnd = random.Random(5)
    sizes = [1, 2, 7, 8, 9, 63, 64, 65, 72, 73, 511, 512, 513, 520, 585, 600]
    names = [None, "", "=", "ä", "a", "Z", "漢"] + [f"g{k}" for k in range(len(sizes) - 7)]
    rows = [(rnd.randrange(-(1 << 62), 1 << 62), f"T{k}", names[g], f"s{k % 3}", k) for g, n in enumerate(sizes) for k in range(n)]
    rows += [(None, "null id", "a", "s", 1), (1 << 60, "LARGE", "a", None, 1), ((1 << 60) + 1, None, "a", "s", None)]
    rows += [(4, "same row", "big", "s", 1)] * 300
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert found(docs, levels=1) == brute([(i, s, g, n, t) for i, t, g, s, n in rows])


def test_one_row(spark):
    docs = spark.createDataFrame([(1, "Ab", "en", "s", 2)], DOCS)
    (row,) = merkle.manifest(docs).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == leaf((1, "s", "en", 2, "Ab"))
    assert row.proof_sha256 == sha("") and row.verified


def test_long_text(spark):
    text = "Long É " * 1_000_000
    docs = spark.createDataFrame([(1, text, "en", "s", 2), (3, text.upper(), "en", "s", 2)], DOCS)
    assert found(docs) == brute([(1, "s", "en", 2, text), (3, "s", "en", 2, text.upper())])


def test_query_equals_sql_and_brute_force(spark):
    got = sorted(map(tuple, QUERIES["op13_merkle_manifest"](spark, SF).collect()), key=str)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.sql(ORACLE_SQL["op13_merkle_manifest"]).fetchall(), key=str)
    assert got == brute(rows_of(spark.read.parquet(f"{SF}/documents.parquet"), *FIELDS))
    assert 0 < sum(r[-1] for r in got) < len(got)
