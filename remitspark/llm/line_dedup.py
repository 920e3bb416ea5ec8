"""Removal of boilerplate lines that stand on many sites.

Lines are grouped by hash. A HyperLogLog sketch of the sites of each line is built before the
shuffle and merged after it. Where the estimate is too near the threshold to tell, and only
there, distinct sites are counted exactly, so the decision is that of an exact count. A line
found on at least ``min_sites`` sites stays once, in the document with the smallest id that has
it, and goes everywhere else. DataFrame functions do all of it.

A line is what stands between line feeds; white space around it doesn't count when lines are
compared, and a blank line is never removed.

Defined results: a null text stays null and has no lines; an empty text has one blank line. A
null site is a site like any other, a null id comes before all others. Rows that share an id and
a text lose the same lines. Texts of any length are split whole, in time that grows with their length. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from remitspark.llm.common import let, stored

MIN_SITES = 10
#: A sketch has 2**12 registers; its standard error is 1.04 / sqrt(2**12) of the count.
REGISTERS_LOG2 = 12
#: Standard errors by which an estimate must be off the threshold to be believed.
SURE = 6

#: White space around a line.
BLANK = " \t\n\x0b\x0c\r"


def _lines(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, site, text_key, pos, high, low) of the lines that are not blank."""
    # The key of a text is computed before its lines are told apart, once a text.
    texts = docs.select("doc_id", "site", F.xxhash64("text").alias("text_key"), F.split("text", "\n").alias("lines"))
    split = texts.select("doc_id", "site", "text_key", F.posexplode("lines"))
    line = split.withColumn("line", F.btrim("col", F.lit(BLANK))).filter("line != ''")
    return line.select("doc_id", "site", "text_key", "pos", *_hashes("line"))


def _hashes(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("high"), F.xxhash64(F.lit(1), line).alias("low")]


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` sites, and where each stands first."""
    lines = _lines(docs).withColumn("site", F.xxhash64("site"))
    sketched = lines.groupBy("high", "low").agg(
        F.hll_sketch_agg("site", F.lit(REGISTERS_LOG2)).alias("sketch"), F.min(F.struct("doc_id", "pos")).alias("first")
    )
    margin = 1 + SURE * 1.04 / 2 ** (REGISTERS_LOG2 / 2) * min_sites
    sites = F.hll_sketch_estimate("sketch")
    spread = sketched.select("high", "low", "first", sites.alias("sites")).filter(F.col("sites") >= min_sites - margin)
    spread = stored(spread, "spread")
    sure, near = spread.filter(F.col("sites") > min_sites + margin), spread.filter(F.col("sites") <= min_sites + margin)
    exact = (
        lines.select("high", "low", "site")
        .join(near.select("high", "low"), ["high", "low"], "left_semi")
        .groupBy("high", "low")
        .agg(F.count_distinct("site").alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    confirmed = near.drop("sites").join(exact.select("high", "low"), ["high", "low"], "left_semi")
    return stored(sure.drop("sites").unionByName(confirmed), "boilerplate")


def _between(lines: Column, gone: Column) -> Column:
    """The lines but for those at some sorted positions: the runs between them, so that long texts take linear time."""
    before, after = F.concat(F.array(F.lit(-1)), gone), F.concat(gone, F.array(F.size(lines)))
    return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def remove_boilerplate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", *, min_sites: int = MIN_SITES
) -> DataFrame:
    """All rows as ``row`` with clean_text, n_lines (blank ones too) and n_removed."""
    columns = {"doc_id": id_col, "text": text_col, "site": site_col}
    whole = docs.select(F.struct("*").alias("row"))
    rows = whole.select("row", *[F.col("row")[name].alias(alias) for alias, name in columns.items()])
    narrow = docs.select(*[F.col(name).alias(alias) for alias, name in columns.items()])
    here = F.struct("doc_id", "pos")
    gone = (
        _lines(narrow)
        .join(boilerplate(narrow, min_sites), ["high", "low"])
        .filter(~here.eqNullSafe(F.col("first")))
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"))
        .agg(F.collect_set("pos").alias("gone"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.xxhash64("text") == F.col("of_text"))
    left = let(F.split("text", "\n"), lambda lines: let(F.sort_array("gone"), lambda gone: _between(lines, gone)))
    return rows.join(gone, same, "left").select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("clean_text"),
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


#: The same result by exact counts.
ORACLE = f"""
WITH split AS (
    SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, source, text, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
    SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM numbered
), spread AS (
    SELECT key, min({{'d': doc_id, 'p': pos}}) AS first FROM keyed WHERE key <> ''
    GROUP BY key HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
    SELECT k.*, s.first IS NOT NULL AND s.first <> {{'d': k.doc_id, 'p': k.pos}} AS gone
    FROM keyed k LEFT JOIN spread s ON k.key = s.key
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS clean_text,
    count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM marked GROUP BY doc_id
"""
