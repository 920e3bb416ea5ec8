from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from math import exp

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitspark.llm import pii
from remitspark.llm.queries import QUERIES
from tests.llm.conftest import DOCS, SF, rows_of

#: The patterns as they are stated.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def holds(kind, word):
    digits = re.sub(r"[^0-9]", "", word)
    if kind == "ip":
        return all(int(part) <= 255 for part in word.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(kind, m.group())]
    return sorted(found)


def shown(spans):
    names = list(PATTERNS)
    return ",".join(f"{names[k]}:{start}:{end}" for start, k, end in spans)


def brute(text):
    spans = base(text)
    counts = Counter(k for _, k, _ in spans)
    return (*[counts[k] for k in range(4)], hashlib.sha256(shown(spans).encode()).hexdigest())


def read(spans):
    return {tuple(x.split(":")) for x in spans.split(",") if x}


def card(rnd, sep=""):
    digits = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    digits += next(d for d in "0123456789" if luhn(digits + d))
    return sep.join(digits[k : k + 4] for k in range(0, 16, 4))


def pieces(rnd):
    n = lambda a, b: str(rnd.randrange(a, b))
    return rnd.choice(
        [
            f"ab.{n(0, 99)}@mail{n(0, 9)}.example.com", "a@b.c_x@d.e", "x@y", "@z.de", "a@b..c", "é@b.c", "u@v.w@x.y", "1.2.3.4@x.com",
            ".".join(n(0, 300) for _ in range(4)), "1.2.3.4.5.6.7.8", "000255.1.1.01", "1..2.3.4.5", "1.2.3", "12", "7",
            card(rnd), card(rnd, " "), card(rnd, "-"), card(rnd, "."), "0" * 14, "9" * 20, "1- 2", n(0, 10**17),
            f"+1 ({n(100, 999)}) 555-{n(1000, 9999)}", "+49.30.123456789", "++1234567890", "+1", "+12", "+123 ", "+1 2)(", f"555-{n(1000, 9999)}",
            f"({n(200, 999)}) {n(200, 999)}-{n(1000, 9999)}", "2024-01-02", "10:20:30", "fe80:0:0:0:1:2:3:4", "version 4.0.", "漢字", "é", "\n", "",
        ]
    )


@pytest.fixture(scope="module")
def mixed(spark):
    rnd = random.Random(11)
    texts = ["".join(pieces(rnd) + rnd.choice(["", " ", " ", "\n", "  ", "x", "."]) for _ in range(rnd.randrange(0, 40))) for _ in range(400)]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate([*texts, "", None])] + [(None, texts[3], None, None, None)] * 2 + [(3, texts[3], "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def compare(docs):
    rows = Counter((str(d), *brute(t)) for d, t in rows_of(docs, "doc_id", "text"))
    found = pii.find(docs).select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added").collect()
    assert Counter((str(r[0]), *r[1:6]) for r in found) == rows
    return found


def test_base_spans(mixed):
    texts = dict(rows_of(mixed, "doc_id", "text"))
    for r in compare(mixed):
        want = set(read(shown(base(texts[r.doc_id]))))
        spans = read(r.spans)
        assert want <= spans and len(spans) == len(want) + r.n_added
        taken = sorted((int(a), int(b)) for kind, a, b in spans - want)
        others = [(int(a), int(b)) for kind, a, b in want] + taken
        assert all(not (a < d and c < b) for a, b in taken for c, d in others if (a, b) != (c, d))
        assert sorted(spans, key=lambda x: (int(x[1]), list(PATTERNS).index(x[0]))) == [tuple(x.split(":")) for x in r.spans.split(",") if x]


def test_odd_rows(spark, odd_docs, no_docs):
    compare(odd_docs)
    found = pii.find(odd_docs)
    assert set(found.select("row.*").columns) == set(odd_docs.columns) - {"text"}
    assert pii.find(no_docs).collect() == []


def test_running_sums_over_blocks(spark):
    rnd = random.Random(2)
    rows = [([rnd.randrange(-5, 50) for _ in range(n)],) for n in (0, 1, pii.BLOCK - 1, pii.BLOCK, pii.BLOCK + 1, 5 * pii.BLOCK + 7)]
    docs = spark.createDataFrame(rows, "v array<long>")
    sums = docs.select("v", pii.running(F.col("v"), lambda a, b: a + b, 0), pii.running(F.col("v"), lambda a, b: F.greatest(a, b), -9))
    for v, total, most in sums.collect():
        assert total == list(np.cumsum(v)) and most == (list(np.maximum.accumulate(v)) if v else [])


def test_long_texts(spark):
    """Texts of megabytes with many matches or none are neither slow nor too deep for the patterns."""
    texts = ["a.b@c.de +1 (234) 567-8901 10.0.0.1 é\n" * 10_000, "+1 (" * 100_000, "a@" * 200_000, "1 " * 200_000]
    compare(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS).repartition(len(texts)))
    texts = ["a" * 6_000_000, "1" * 3_000_000, "1.1." * 20_000]  # plain matching is quadratic here
    found = pii.find(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS).repartition(3))
    spans = {r.row.doc_id: r.spans for r in found.collect()}
    assert spans == {0: "", 1: "", 2: ",".join(f"ip:{k}:{k + 7}" for k in range(0, 80_000, 8))}


def corpus(spark):
    """Many strict matches, phones and cards written in other ways, and numbers that are neither."""
    rnd = random.Random(4)
    n = lambda a, b: str(rnd.randrange(a, b))
    rows = []
    for k in range(300):
        phone = f"({n(201, 999)}) {n(201, 999)}-{n(1000, 9999)}"
        rows += [
            f"call +1 {phone} or", f"phone {phone} or", f"tel: {phone} or", f"card {card(rnd)} or", f"visa {card(rnd, '.')} or",
            f"in 20{n(10, 30)}-{n(10, 12)}-{n(10, 28)} we", f"order {n(10**7, 10**8)} or", f"total {n(10**15, 10**16)} or", "nothing",
        ]
    return rows, spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(rows)], DOCS)


def test_the_method_adds_what_patterns_miss(spark):
    texts, docs = corpus(spark)
    taken = {k: read(s) for k, s in pii.find(docs).select("row.doc_id", "spans").collect()}
    of_kind = lambda at: [taken[k] for k in range(at, len(texts), 9)]
    for at, kind in ((0, "phone"), (1, "phone"), (2, "phone"), (3, "card"), (4, "card")):
        assert np.mean([any(s[0] == kind for s in spans) for spans in of_kind(at)]) > 0.95, at
    for at in (5, 6, 8):
        assert not any(of_kind(at)), at
    # One number in ten has the right check digit by chance.
    assert np.mean([bool(spans) for spans in of_kind(7)]) < 0.2


def test_expectation_maximisation(spark):
    """The same estimates as plain arithmetic; labelers that are right more often are worth more."""
    rnd = np.random.default_rng(1)
    right = [0.95, 0.8, 0.65, 0.9]
    truth = rnd.random(20_000) < 0.5
    votes = [tuple((1 if t else -1) * (1 if rnd.random() < r else -1) if rnd.random() < 0.7 else 0 for r in right) for t in truth]
    counts = Counter(votes)
    rows = [(0, list(v), n) for v, n in sorted(counts.items())]
    evidence = pii.reliabilities(spark.createDataFrame(rows, "kind int, votes array<int>, n long"))
    want = [(np.log(4), -np.log(4))] * 4
    for _ in range(pii.ROUNDS):
        believed = {v: 1 / (1 + exp(-sum(w[0] if x == 1 else w[1] if x == -1 else 0 for x, w in zip(v, want)))) for v in counts}
        new = []
        for j in range(4):
            yes = {x: pii.ASSUMED[1][x] + sum(n * believed[v] for v, n in counts.items() if v[j] == x) for x in (-1, 1)}
            no = {x: pii.ASSUMED[0][x] + sum(n * (1 - believed[v]) for v, n in counts.items() if v[j] == x) for x in (-1, 1)}
            new.append(tuple(np.log(yes[x] / sum(yes.values()) / (no[x] / sum(no.values()))) for x in (1, -1)))
        moved = max(abs(a - b) for x, y in zip(new, want) for a, b in zip(x, y))
        want = new
        if moved < pii.CLOSE:
            break
    assert np.allclose(evidence[0], want)
    worth = [yes - no for yes, no in evidence[0]]
    assert sorted(range(4), key=lambda j: -worth[j]) == [0, 3, 1, 2]
    estimated = [np.exp(yes) * (1 - np.exp(no)) / (np.exp(yes) - np.exp(no)) for yes, no in evidence[0]]  # rate of votes for, in class 1
    assert np.allclose(estimated, right, atol=0.03)


def test_no_python_runs(spark):
    plan = QUERIES["op12_personal_data"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = spark.createDataFrame([], DOCS).select("doc_id", "text")
    plan = pii.spans_of(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_table(spark):
    found = {r.doc_id: r for r in QUERIES["op12_personal_data"](spark, SF).collect()}
    docs = rows_of(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")
    assert len(found) == len(docs)
    for doc_id, text in docs:
        assert tuple(found[doc_id])[1:6] == brute(text)
