from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from remitspark.llm import divergence
from remitspark.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import DOCS, SF, rows_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    """Rows of the audit from (text, lang, source), one word at a time."""
    of_group, of_lang, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]
        of_group[lang, source].update(words)
        of_lang[lang].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in of_lang:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def prices(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        groups = {s: prices(c) for (x, s), c in of_group.items() if x == lang}
        q = prices(of_lang[lang])
        for source, p in groups.items():
            parts = {"pair": [(s, sum(abs(p[t] - o[t]) for t in kept)) for s, o in groups.items() if s != source]}
            parts["term"] = [(t, p[t] - q[t]) for t in kept if of_group[lang, source][t] and p[t] > q[t]]
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, divergence.audit(docs, **options).collect()))


@pytest.mark.parametrize("min_docs", [1, 5, 10_000])
def test_odd_rows(spark, odd_docs, no_docs, min_docs):
    rows = rows_of(odd_docs, "text", "lang", "source")
    assert found(odd_docs, min_docs=min_docs) == brute(rows, min_docs, 50)
    assert found(no_docs, min_docs=min_docs) == []


def test_many_groups_and_levels(spark):
    """Groups in several tiles, counts on many levels, groups without words, a group alone, ties."""
    rnd = random.Random(3)
    rows = []
    for k in range(1500):
        text = " ".join(rnd.choice(["Alpha", "beta", "ZÜGE", "züge", "漢字", "x1y"]) * rnd.choice([1, 1, 2]) for _ in range(rnd.choice([0, 1, 5, 90])))
        rows.append((k, text, rnd.choice(["en", "en", "de", None]), f"s{int(150 * rnd.random() ** 2)}", 1))
    rows += [(0, "", "en", "empty", 0), (0, None, "en", None, 0), (0, "alpha", "alone", "s1", 0), (0, "...", "silent", "a", 0), (0, "", "silent", "b", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert found(docs, min_docs=3, top_terms=2) == brute([(t, g, s) for _, t, g, s, _ in rows], 3, 2)


def test_blocks_of_the_product(spark):
    """One block, cut into several products, holds the same tables as counting words one by one."""
    import pandas as pd

    rnd = random.Random(9)
    counts = {(w, g): rnd.choice([0, 0, 1, 2, 7, rnd.randrange(10_000)]) for w in range(3000) for g in range(6)}
    rows = [(w, g, n, 6) for (w, g), n in counts.items() if n]
    block = divergence._joint(("en", 0, 0, 0), pd.DataFrame(rows, columns=["term_no", "g", "n", "groups"]))
    want = Counter()
    for w in range(3000):
        for a in range(6):
            for b in range(a + 1, 6):
                want[a, counts[w, a], b, counts[w, b]] += any(counts[w, g] for g in range(6))
    want = {k: n for k, n in want.items() if n and (k[1] or k[3])}
    got = Counter()
    for _, a, x, b, y, n in block.itertuples(index=False):
        got[a, x, b, y] += n
    assert got == want


def test_words_with_one_hash(monkeypatch):
    """Words are told apart also when their hashes are alike."""
    import numpy as np

    data = np.frombuffer(b"one two One three two", np.uint8)
    start, end, _ = divergence.word_bounds(data, np.array([0, len(data)]), divergence.NO_LETTER)
    monkeypatch.setattr(divergence, "Hasher", lambda data, lower: lambda start, end: np.zeros(len(start), np.uint64))
    first, number = divergence._distinct_words(data, start, end)
    assert len(first) == 3 and number[0] == number[2] and number[1] == number[4]


def test_long_text(spark):
    texts = ["Ab cd é " * 900_000, "ab " * 10, None]
    docs = spark.createDataFrame([(k, t, "en", f"s{k}", 1) for k, t in enumerate(texts)], DOCS)
    assert found(docs, min_docs=1) == brute([(t, "en", f"s{k}") for k, t in enumerate(texts)], 1, 50)


def test_query_equals_sql_and_brute_force(spark):
    got = sorted(map(tuple, QUERIES["op11_source_divergence"](spark, SF).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.sql(ORACLE_SQL["op11_source_divergence"]).fetchall())
    assert got == brute(rows_of(spark.read.parquet(f"{SF}/documents.parquet"), "text", "lang", "source"), 30, 50)
    assert {r[2] for r in got} == {"pair", "term"}
