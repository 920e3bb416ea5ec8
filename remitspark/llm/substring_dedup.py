"""Removal of repeated passages by hashing lines and parts of lines.

The unit is a line; a long line is cut into parts at places that its own words decide, so
that a passage copied into the middle of another line gives the same units there. Units are
compared without regard to ASCII case and white space. Of equal units the first by document id
and place stays, all others are removed; where they stood is returned as offsets in the original
text. Whole lines count whatever their length, a text without white space as a line of one word;
a part cut out of a longer line has five words at least. Equal lines have equal cuts, so a line
that repeats as a whole goes with all of its parts.

Repeats within a document are found in the task that reads it, so only one row per document and
unit is shuffled, and equal units are counted before the shuffle.

Defined results: a null text stays null, an empty one empty, without spans. Rows that share an
id count as one document: none of them loses a unit to the other. Rows without an id come after
all others, as one document. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from remitspark.llm.common import arrow_schema, stored
from remitspark.llm.textarrays import Passages, char_positions, slices, text_bytes

#: Words in the smallest unit: every line that is not blank.
MIN_WORDS = 1
REACH = 5
LAST_RANK = (1 << 63) - 1
UNITS = "rank long, text_key long, high long, low long, start int, stop int, again boolean"


def units(docs: DataFrame) -> DataFrame:
    """Rows of the units of all documents; ``again`` marks those that came before in the document.

    Offsets count code points.
    """
    arrow = arrow_schema(docs.sparkSession.createDataFrame([], UNITS).schema)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            passages = Passages(data, offsets, REACH)
            chosen = np.flatnonzero(passages.words >= MIN_WORDS)
            row = passages.row[chosen]
            high, low = (d[chosen].view(np.int64) for d in passages.digests)
            order = np.lexsort((np.arange(len(row)), low, high, row))
            same = np.zeros(len(row), dtype=bool)
            same[1:] = (row[order][1:] == row[order][:-1]) & (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
            again = np.zeros(len(row), dtype=bool)
            again[order] = same
            chars = char_positions(data, offsets)
            base = chars[offsets[:-1]][row]
            start = chars[passages.word_start[passages.first[chosen]]] - base
            # White space after a unit goes with it, but for the end of its line.
            following = np.append(passages.word_start, len(data))[passages.after[chosen]]
            ends = passages.word_end[passages.after[chosen] - 1]
            stop = chars[np.where(passages.in_line[chosen], following, ends)] - base
            rows = pa.array(row)
            columns = [batch.column("rank").take(rows), batch.column("text_key").take(rows), pa.array(high), pa.array(low)]
            columns += [pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(again)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select("rank", "text_key", "text").mapInArrow(find, UNITS)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
    """The texts without the spans, which are in order."""

    def rest(text: str, start: list[int], stop: list[int]) -> str:
        return "".join(text[a:b] for a, b in zip([0, *stop], [*start, len(text)], strict=True))

    return pd.Series([None if a is None else rest(t, a, b) for t, a, b in zip(texts, starts, stops, strict=True)])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows as ``row`` with clean_text, removed (spans of start and stop) and n_removed."""
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_RANK)).alias("rank")
    keys = [rank, F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")]
    found = stored(units(docs.select(*keys)), "units")
    firsts = found.filter("NOT again").groupBy("high", "low").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    repeated = stored(firsts.filter("first < last").select("high", "low", "first"), "repeated")
    later = found.filter("NOT again").join(repeated, ["high", "low"]).filter("rank > first")
    spans = (
        later.select("rank", "text_key", "start", "stop")
        .union(found.filter("again").select("rank", "text_key", "start", "stop"))
        .groupBy(F.col("rank").alias("of_rank"), F.col("text_key").alias("of_text"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("removed"))
    )
    rows = docs.select(F.struct("*").alias("row"), *keys)
    joined = rows.join(spans, (F.col("rank") == F.col("of_rank")) & (F.col("text_key") == F.col("of_text")), "left")
    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    removed = F.coalesce("removed", nothing)
    clean = F.when(F.col("removed").isNull(), F.col("text")).otherwise(_without("text", "removed.start", "removed.stop"))
    return joined.select("row", clean.alias("clean_text"), removed.alias("removed"), F.size(removed).cast("long").alias("n_removed"))
