"""Audit of how far the sources of a language differ in their words.

Words are counted once, in tasks, to one row per (language, source, word). A language keeps the words
that enough of its documents have. A group is a source in a language; its prices are smoothed shares
of the kept words in billionths, so that all arithmetic is exact.

How far two groups differ is a sum over all kept words, but it depends on a word only through its two
counts. So the words are rows of an indicator matrix with one column per (group, count level). The
matrix times its transpose holds, for any two groups, how many words have which pair of levels: their
joint table. The product is computed in blocks. A block has the words of one bucket and the groups of two
tiles; within it words of similar frequency stand together and are cut so that a block has at most
``COLUMNS`` columns, which bounds its memory whatever the number of words or groups is. Products are
whole numbers below 2 ** 24, which floats hold exactly. The joint tables of all blocks are summed, and
only then priced. Words that neither group of a pair has in a block are not counted there; their
number follows from the number of kept words.

Defined results: null texts, languages and sources count as empty, and an empty name is a name like any
other. A group without kept words has all counts 0. A language without kept words has no ``term`` rows
and its pairs have value 0; a group that is alone in its language has no pairs. Repeated rows count as
often as they occur; ids are not read. Ties are in the order of the items' UTF-8 bytes. Texts of any length
are counted whole, with some fifty times their size in memory. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from remitspark.llm.common import stored
from remitspark.llm.textarrays import LOWER, NO_LETTER, Hasher, heads, slices, text_bytes, word_bounds
from remitspark.tables import fits_broadcast

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTH = 5
SCALE = 1_000_000_000
#: Groups in a tile, cells of counts in a block, columns of a product.
TILE = 64
CELLS = 1 << 18
COLUMNS = 2048

COUNTED = "lang string, source string, term string, n long, docs long"
JOINT = "lang string, a long, level_a long, b long, level_b long, n long"


def _distinct_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of every different word, and the number of each word among them; A to Z count as a to z."""
    shown = LOWER[data]
    _, first, number = np.unique(Hasher(shown, lower=False)(start, end), return_index=True, return_inverse=True)
    known = heads(shown, start, end)
    if (known[first][number] != known).any():  # two words with one hash
        text = shown.tobytes()
        words = np.array([text[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)], dtype=object)
        _, first, number = np.unique(words, return_index=True, return_inverse=True)
    return first, number


def _word_texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(end - start)])
    at = np.repeat(start - bounds[:-1], end - start) + np.arange(bounds[-1])
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(LOWER[data][at])])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every word of a slice by group."""
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        start, end, row = word_bounds(data, offsets, NO_LETTER)
        if not len(start):
            continue
        names = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
        lang, source = (x.indices.to_numpy().astype(np.int64) for x in names)
        sources = len(names[1].dictionary)
        group = lang * sources + source
        groups = len(names[0].dictionary) * sources
        first, number = _distinct_words(data, start, end)
        keys, place = np.unique(number * groups + group[row], return_inverse=True)
        _, one = np.unique(number * batch.num_rows + row, return_index=True)  # one occurrence a word and document
        word, of = first[keys // groups], keys % groups
        columns = [names[0].dictionary.take(pa.array(of // sources)), names[1].dictionary.take(pa.array(of % sources))]
        columns.append(_word_texts(data, start[word], end[word]).cast(pa.string()))
        columns += [pa.array(np.bincount(x, minlength=len(keys))) for x in (place, place[one])]
        yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _TYPES, strict=True)], names=["lang", "source", "term", "n", "docs"])


_TYPES = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())


def price(count: Column, total: Column, kept: Column) -> Column:
    """A smoothed share of the kept words in billionths; null if there are none."""
    wide = "decimal(19,0)"
    share = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTH).cast(wide)
    return F.call_function("div", share, F.nullif(total + SMOOTH * kept, F.lit(0).cast("long")).cast(wide)) + 1


def _joint(key: tuple, entries: pd.DataFrame) -> pd.DataFrame:
    """Joint tables of the groups of two tiles over the words of a bucket, but for words that neither group has."""
    lang, one, two = key[:3]
    groups = int(entries["groups"].iloc[0])
    numbers = [np.arange(k * TILE, min((k + 1) * TILE, groups)) for k in sorted({one, two})]
    of_column = np.concatenate(numbers)
    _, word = np.unique(entries["term_no"].to_numpy(), return_inverse=True)
    counts = np.zeros((word.max() + 1, len(of_column)), dtype=np.int64)
    counts[word, np.searchsorted(of_column, entries["g"].to_numpy())] = entries["n"].to_numpy()
    counts = counts[np.argsort(-counts.sum(axis=1), kind="stable")]
    out = [np.zeros((5, 0), dtype=np.int64)]
    todo = [counts]
    while todo:
        block = todo.pop()
        levels = [np.unique(column, return_inverse=True) for column in block.T]
        width = sum(len(values) for values, _ in levels)
        if width > COLUMNS and len(block) > 1:
            todo += [block[: len(block) // 2], block[len(block) // 2 :]]
            continue
        level = np.concatenate([values for values, _ in levels])
        group = np.repeat(of_column, [len(values) for values, _ in levels])
        begin = np.cumsum([0, *[len(values) for values, _ in levels]])
        hot = np.zeros((len(block), width), dtype=np.float32)
        for k, (_, at) in enumerate(levels):
            hot[np.arange(len(block)), begin[k] + at] = 1
        tile = group // TILE
        left, right = np.flatnonzero(tile == one), np.flatnonzero(tile == two)
        product = hot[:, left].T @ hot[:, right]
        a, b = np.nonzero(product)
        n = product[a, b].astype(np.int64)
        a, b = left[a], right[b]
        counted = (group[a] < group[b]) & ((level[a] > 0) | (level[b] > 0))
        a, b, n = a[counted], b[counted], n[counted]
        out.append(np.stack([group[a], level[a], group[b], level[b], n]))
    found = pd.DataFrame(np.concatenate(out, axis=1).T, columns=["a", "level_a", "b", "level_b", "n"])
    found.insert(0, "lang", lang)
    return found


def joint_tables(entries: DataFrame) -> DataFrame:
    """Rows (lang, a, level_a, b, level_b, n): so many words have these counts in groups a < b of a language.

    ``entries`` has lang, g, groups, kept, term_no and n. Pairs of level 0 are left out.
    """
    tiles = F.ceil(F.col("groups") / TILE)
    buckets = F.ceil(F.col("kept") * F.least(F.col("groups"), F.lit(2 * TILE)) / CELLS)
    tile = F.floor(F.col("g") / TILE)
    dealt = entries.filter("groups > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    dealt = dealt.select(
        "lang",
        F.least(tile, "other").alias("one"),
        F.greatest(tile, "other").alias("two"),
        F.pmod(F.xxhash64("term_no"), buckets).alias("bucket"),
        "g",
        "groups",
        "term_no",
        "n",
    )
    blocks = dealt.groupBy("lang", "one", "two", "bucket").applyInPandas(_joint, JOINT)
    return blocks.groupBy("lang", "a", "level_a", "b", "level_b").agg(F.sum("n").alias("n"))


def _with(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(F.broadcast(table) if fits_broadcast(table) else table, keys)


def _pairs(groups: DataFrame, joint: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) of all ordered pairs of groups of a language."""

    def side(name: str, *others: str | Column) -> DataFrame:
        return groups.select("lang", F.col("g").alias(name), F.col("total").alias(f"total_{name}"), *others)

    def gap(level_a: Column, level_b: Column) -> Column:
        return F.abs(price(level_a, F.col("total_a"), F.col("kept")) - price(level_b, F.col("total_b"), F.col("kept")))

    priced = _with(_with(joint, side("a", "kept"), ["lang", "a"]), side("b"), ["lang", "b"])
    value = F.col("n") * gap(F.col("level_a"), F.col("level_b"))
    priced = priced.groupBy("lang", "a", "b").agg(F.sum(value).alias("part"), F.sum("n").alias("seen"))
    # A group meets the others of its language tile by tile, so that no language is one task.
    tiles = F.sequence(F.floor(F.col("a") / TILE), F.ceil(F.col("groups") / TILE) - 1)
    left = side("a", "kept", "groups", F.col("source").alias("one")).withColumn("tile", F.explode(tiles))
    right = side("b", F.col("source").alias("two")).withColumn("tile", F.floor(F.col("b") / TILE))
    both = left.join(right, ["lang", "tile"])
    both = both.filter("a < b").join(priced, ["lang", "a", "b"], "left")
    none = F.lit(0).cast("long")
    unseen = F.col("kept") - F.coalesce("seen", none)
    value = F.coalesce("part", none) + F.coalesce(unseen * gap(none, none), none)
    ways = [F.struct(F.col(source).alias("source"), F.col(item).alias("item")) for source, item in (("one", "two"), ("two", "one"))]
    found = both.select("lang", value.alias("value"), F.explode(F.array(*ways)).alias("pair"))
    return found.select("lang", "pair.source", "pair.item", "value")


def _terms(entries: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) of the words that a group has more often than its language."""
    value = price(F.col("n"), F.col("total"), F.col("kept")) - price(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    return entries.select("lang", "source", F.col("term").alias("item"), value.alias("value")).filter("value > 0")


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    *,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair`` for every other source of the language,
    ``term`` for the words by which a group differs most from its language."""
    columns = {"text": text_col, "lang": lang_col, "source": source_col}
    rows = docs.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(alias) for alias, name in columns.items()])
    pieces = rows.mapInArrow(_counted, COUNTED)
    counts = stored(pieces.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    words = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= min_docs)
    words = stored(words.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_no")), "words")
    entries = stored(_with(counts.select("lang", "source", "term", "n"), words, ["lang", "term"]), "entries")

    langs = words.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang")
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(
        groups.select(
            "lang",
            "source",
            (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("g"),
            F.count(F.lit(1)).over(by_lang).alias("groups"),
            *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("total", "kept", "lang_total")],
        ),
        "groups",
    )
    entries = _with(entries, groups, ["lang", "source"])
    group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(found: DataFrame, part: str) -> DataFrame:
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(group).alias("rank"))

    pairs = ranked(_pairs(groups, stored(joint_tables(entries), "joint")), "pair")
    return pairs.unionByName(ranked(_terms(entries), "term").filter(F.col("rank") <= top_terms))


#: The same result by joins of counts.
ORACLE = f"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= {MIN_DOCS}
), langs AS (
    SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT g.lang, g.source, k.term, k.lang_n, v, lang_total, count(w.term) AS n
    FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN words w USING (lang, source, term) GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), priced AS (
    SELECT c.*, 1 + {SCALE}::HUGEINT * (n + {SMOOTH}) // (total + {SMOOTH} * v) AS p,
        1 + {SCALE}::HUGEINT * (lang_n + {SMOOTH}) // (lang_total + {SMOOTH} * v) AS q
    FROM counts c JOIN totals USING (lang, source)
), gaps AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(g.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM priced WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
