from __future__ import annotations

import random
import re

import pyarrow as pa

from remitspark.llm import substring_dedup as D
from remitspark.llm.textarrays import Passages, text_bytes
from tests.llm.conftest import DOCS, SF, rows_of


def units(text):
    """Units of one text alone: (start, stop, digest) in code points."""
    data, offsets = text_bytes(pa.array([text or ""]))
    found = Passages(data, offsets, D.REACH)
    raw, out = (text or "").encode(), []
    for k in range(len(found.first)):
        if found.words[k] < D.MIN_WORDS:
            continue
        start, end = found.word_start[found.first[k]], found.word_end[found.after[k] - 1]
        stop = found.word_start[found.after[k]] if found.in_line[k] else end
        words = re.findall(rb"[^\x20\x09-\x0D]+", raw[start:end].lower())
        out.append((len(raw[:start].decode()), len(raw[:stop].decode()), b" ".join(words)))
    return out


def brute(rows):
    """Spans removed from every row."""
    rank = lambda doc_id: D.LAST_RANK if doc_id is None else doc_id
    first = {}
    for doc_id, text in rows:
        for _, _, unit in units(text):
            first[unit] = min(first.get(unit, D.LAST_RANK), rank(doc_id))
    out = []
    for doc_id, text in rows:
        seen, spans = set(), []
        for start, stop, unit in units(text):
            if unit in seen or rank(doc_id) > first[unit]:
                spans.append((start, stop))
            seen.add(unit)
        out.append((doc_id, text, spans))
    return out


def check(docs):
    want = {(d, t): spans for d, t, spans in brute(rows_of(docs, "doc_id", "text"))}
    found = D.remove_repeats(docs)
    rows = found.collect()
    assert len(rows) == docs.count() and found.select("row.*").columns == docs.columns
    copies = {}
    for r in rows:
        copies[r.row.doc_id, r.row.text] = copies.get((r.row.doc_id, r.row.text), 0) + 1
    for r in rows:
        spans = [(s.start, s.stop) for s in r.removed]
        expected = want[r.row.doc_id, r.row.text]
        assert sorted(set(spans)) == expected, r.row.doc_id
        assert r.n_removed == len(spans)
        if r.row.text is None:
            assert r.clean_text is None
            continue
        if copies[r.row.doc_id, r.row.text] == 1:
            assert r.clean_text == "".join(
                r.row.text[a:b] for a, b in zip([0, *[y for _, y in expected]], [*[x for x, _ in expected], len(r.row.text)])
            )


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_passages_inside_other_lines(spark):
    rnd = random.Random(4)
    fresh = lambda n: " ".join(f"v{rnd.randint(0, 10**6)}" for _ in range(n))
    rows, passages = [], []
    for i in range(60):
        passage = fresh(51)
        passages.append(passage)
        rows += [(i, f"{fresh(20)} {passage} {fresh(9)}", "en", "s", 1), (100 + i, f"{fresh(7)}  {passage.upper()}\n{fresh(30)}", "en", "s", 1)]
    rows += [(300 + i, fresh(80), "en", "s", 1) for i in range(40)]
    found = {r.row.doc_id: r for r in D.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(found[i].n_removed == 0 and found[i].clean_text == found[i].row.text for i in [*range(60), *range(300, 340)])
    assert sum(found[100 + i].n_removed > 0 for i in range(60)) >= 59
    removed = [len(found[100 + i].row.text) - len(found[100 + i].clean_text) for i in range(60)]
    assert sum(removed) > 0.5 * sum(map(len, passages))


def test_lines_of_any_length(spark):
    """Held against plain lines: of equal ones the first stays, also of one word or without a space."""
    lines = ["}", "All rights reserved.", "ALL  rights\treserved.", "Released under the MIT License.", "five words are a line", "漢字かな" * 250]
    lines += ["ข้อความไทย" * 100, "https://example.org/" + "a1b2c3" * 60, "QUJDRA" * 300, "six words are a line too"]
    rnd = random.Random(5)
    rows = [(i, "\n".join(rnd.choices([*lines, "", f"own{i}", f"own line {i}"], k=8)), "en", "s", 1) for i in range(60)]
    key = lambda line: tuple(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
    seen, want = set(), {}
    for doc_id, text, *_ in rows:
        left = []
        for line in text.split("\n"):
            left.append("" if key(line) in seen else line)
            seen.update([key(line)] if key(line) else [])
        want[doc_id] = "\n".join(left)
    found = D.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert {r.row.doc_id: r.clean_text for r in found} == want


def test_equal_long_lines_go_whole(spark):
    rnd = random.Random(6)
    lines = [" ".join(f"v{rnd.randint(0, 10**6)}" for _ in range(60)) for _ in range(200)]
    # Some cut stands right after the fifth word.
    assert any(len(unit.split()) == 5 for line in lines for _, _, unit in units(line))
    rows = [(i, f"own {i}\n{line}", "en", "s", 1) for i, line in enumerate(lines)]
    rows += [(1000 + i, f"{line}\nother {i}", "en", "s", 1) for i, line in enumerate(lines)]
    rows += [(2000 + i, text.upper(), "en", "s", 1) for i, text, *_ in rows[:200]]  # copies of documents
    found = {r.row.doc_id: r.clean_text for r in D.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert all(found[i] == rows[i][1] for i in range(200))
    assert all(found[1000 + i] == f"\nother {i}" and found[2000 + i] == "\n" for i in range(200))


def test_no_documents(spark, no_docs):
    assert D.remove_repeats(no_docs).collect() == []
