"""From raw documents to packed sequences: five stages over the whole table of documents.

``run`` applies the stages in order. Each stage's rows are written as Parquet to the shared work
folder and read again as the next one's documents. All stages but the last return the columns
of documents:

1. quality classifier: documents rejected by the resampling go;
2. line dedup: boilerplate lines go from the texts, n_chars is counted anew;
3. MinHash near-dedup: one document of each group of near copies stays, the one with the smallest id,
   or of those without an id if the group has no other;
4. mixing: a document comes as many times as the mix takes it; what is left of a source's words is
   the beginning of one document;
5. packing: pieces of all documents in sequences.

Null ids and texts pass; an empty table gives no rows. Rows that share an id and have different
texts are documents of their own in near-dedup. Columns with any other names are passed on up to
the last stage.
"""

from __future__ import annotations

import re
from itertools import islice

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from remitspark.llm import line_dedup, minhash_dedup, mixing, packing, quality
from remitspark.llm.common import stored, table

#: Words in a shingle, and similarity of near copies in hundredths.
SHINGLE_WORDS = 5
SIMILARITY = 80
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.resample(docs, table(spark, sf_dir, "labels")).filter("kept").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(docs).select("row", "clean_text")
    row = F.col("row").withField("text", F.col("clean_text")).withField("n_chars", F.length("clean_text").cast("long"))
    return cleaned.select(row.alias("row")).select("row.*")


def _id_text() -> Column:
    """The id as text, null as empty: one key for joins that null takes part in."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text")


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Id and text are the key of a row: rows that share an id, and those without one, are documents of
    # their own. Keys without an id come last, so a group with an id keeps the smallest id.
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_key"))
    found = minhash_dedup.near_duplicates(docs.select(key.alias("key"), "text"), "key", words=SHINGLE_WORDS, similarity=SIMILARITY)
    kept = found.filter("kept").select("doc_id.*").select(_id_text(), "text_key").distinct()
    rows = docs.select(F.struct("*").alias("row"), _id_text(), F.xxhash64("text").alias("text_key"))
    # Rows of one id and text are copies as well.
    first = F.row_number().over(Window.partitionBy("id_text", "text_key").orderBy(F.lit(0)))
    return rows.join(kept, ["id_text", "text_key"], "left_semi").withColumn("place", first).filter("place = 1").select("row.*")


@F.pandas_udf(T.StringType())
def _first_words(texts: pd.Series, words: pd.Series) -> pd.Series:
    """The beginnings of the texts with so many words; null for null."""

    def cut(text: str, n: int) -> str:
        found = next(islice(WORDS.finditer(text), n - 1, None), None)
        return text[: found.end()] if found else text

    return pd.Series([None if text is None else cut(text, n) for text, n in zip(texts, words, strict=True)])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(docs).groupBy(_id_text(), F.col("salt").alias("key"))
    mixed = mixed.agg(F.first("size").alias("size"), F.sum("taken").alias("taken")).filter("taken > 0")
    rows = docs.select(F.struct("*").alias("row"), _id_text(), F.xxhash64("doc_id", "source", "text").alias("key"))
    # Rows that are alike in all of these are one document here, with the words of all of them.
    first = F.row_number().over(Window.partitionBy("id_text", "key").orderBy(F.lit(0)))
    found = rows.withColumn("place", first).filter("place = 1").join(mixed, ["id_text", "key"])
    part = F.col("taken") % F.col("size")
    whole = F.array_repeat(F.col("size"), F.floor(F.col("taken") / F.col("size")).cast("int"))
    words = F.when(part > 0, F.array_append(whole, part)).otherwise(whole)
    copies = found.select("row", "size", F.explode(words).alias("words"))
    start = _first_words(F.when(F.col("words") < F.col("size"), F.col("row.text")), "words")
    text = F.coalesce(start, F.col("row.text"))
    n_chars = F.when(F.col("words") < F.col("size"), F.length(text).cast("long")).otherwise(F.col("row.n_chars"))
    return copies.select(F.col("row").withField("text", text).withField("n_chars", n_chars).alias("row")).select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_copy_stage),
    ("mixing sources", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the sampling, the rounding or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
