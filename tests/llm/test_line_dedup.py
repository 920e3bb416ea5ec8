from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

from remitspark.llm import line_dedup
from remitspark.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import DOCS, SF, rows_of


def brute(rows, min_sites):
    """Per row: the lines that stay, number of lines and of removed ones."""
    sites, first = defaultdict(set), {}
    key = lambda line: line.strip(line_dedup.BLANK)
    order = lambda doc_id: (doc_id is not None, doc_id or 0)
    for doc_id, text, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            sites[key(line)].add(site)
            here = (order(doc_id), pos)
            first[key(line)] = min(first.get(key(line), here), here)
    out = []
    for doc_id, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        gone = [bool(key(x)) and len(sites[key(x)]) >= min_sites and first[key(x)] != (order(doc_id), p) for p, x in enumerate(lines)]
        left = None if text is None else "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((doc_id, left, len(lines), sum(gone)))
    return out


def sort(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("min_sites", [1, 3, 10, 60])
def test_equals_exact_counts(spark, min_sites):
    rows = [(i, f"L{i % 7}\n  L{i % 11} \n\nown {i}\nL{i % 7}", "en", f"s{i % (3 + i % 60)}", 1) for i in range(400)]
    rows += [(None, "L1\nL2", "en", None, 1), (None, None, "en", "s1", 1), (3, "L3", "en", "s3", 1), (500, "", "en", "s1", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    found = line_dedup.remove_boilerplate(docs, min_sites=min_sites).select("row.doc_id", "clean_text", "n_lines", "n_removed")
    want = brute([(r[0], r[1], r[3]) for r in rows], min_sites)
    assert sort(map(tuple, found.collect())) == sort(want)


def test_odd_rows(spark, odd_docs, no_docs):
    found = line_dedup.remove_boilerplate(odd_docs, min_sites=2)
    got = [(r.row.doc_id, r.clean_text, r.n_lines, r.n_removed) for r in found.collect()]
    assert sort(got) == sort(brute(rows_of(odd_docs, "doc_id", "text", "source"), 2))
    assert found.select("row.*").columns == odd_docs.columns
    assert line_dedup.remove_boilerplate(no_docs).collect() == []


def test_no_python_runs(spark):
    found = QUERIES["op2_line_dedup"](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark):
    got = QUERIES["op2_line_dedup"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLE_SQL["op2_line_dedup"]).df().sort_values("doc_id").reset_index(drop=True)
    for name in want.columns:
        assert (got[name] == want[name]).all(), name


def test_long_text(spark):
    """A million lines, half of them boilerplate, in one text of several slices."""
    long = "\n".join(f"own line {k}" if k % 2 else f"shared {k % 1000}" for k in range(1_000_000))
    rows = [(k, "\n".join(f"shared {n}" for n in range(0, 1000, 2)), "en", f"s{k}", 1) for k in range(3)] + [(9, long, "en", "s9", 1)]
    found = line_dedup.remove_boilerplate(spark.createDataFrame(rows, DOCS), min_sites=3).filter("row.doc_id = 9").first()
    assert (found.n_lines, found.n_removed) == (1_000_000, 500_000)
    assert found.clean_text == "\n".join(f"own line {k}" for k in range(1, 1_000_000, 2))
