"""Document fingerprints: invertible Bloom lookup tables of passage digests.

A text is cut into passages: lines, and parts of long lines cut where their own words decide.
A fingerprint is a small table into which the digest of every passage is added in three cells,
each with a count, a sum of digests and a sum of checks. The tables of two versions subtract
cell by cell; cells with one digest left are peeled until all differing digests are known. If
peeling gets stuck, both versions are added to tables four times as large, until it does not.
Likeness is the share of passages in common among all passages of both.

The tables of many documents are one array, and peeling works on all of them at once.

Defined results: a null text counts as empty. Two texts without words have likeness 1, one
with and one without 0. Documents are in descending order of id, nulls last, rows with one id
in the order of a hash of their texts; so repeated rows follow each other. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from remitspark.llm.common import arrow_schema
from remitspark.llm.textarrays import BASE, Hasher, Passages, mix, slices, text_bytes

REACH = 2
CELLS = 18
GROWTH = 4
CELL = np.dtype([("count", "<i4"), ("digests", "<u8"), ("checks", "<u4")])
SALTS = mix(np.arange(1, 4, dtype=np.uint64) + BASE)
BUCKET_ROWS = 4000
#: Bounds of buckets that the driver holds, at most; beyond 400 million documents buckets grow.
MOST_BUCKETS = 100_000
#: Both versions of a slice are hashed side by side, so slices are small.
SLICE_BYTES = 1 << 19


class Digests:
    """Digests of the passages of all texts of a batch, a repeated passage with its number."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        passages = Passages(data, offsets, REACH)
        start, self.row, self.rows = passages.word_start[passages.first], passages.row, len(offsets) - 1
        head = np.append(True, self.row[1:] != self.row[:-1])[: len(start)]
        start = np.where(head, offsets[:-1][self.row], start)
        end = np.append(start[1:], 0)
        last = np.append(self.row[1:] != self.row[:-1], True)[: len(start)]
        end = np.where(last, offsets[1:][self.row], end[: len(start)])
        found = Hasher(data, lower=False)(start, end)
        order = np.lexsort((found, self.row))
        same = np.zeros(len(found), dtype=bool)
        same[1:] = (found[order][1:] == found[order][:-1]) & (self.row[order][1:] == self.row[order][:-1])
        place = np.arange(len(found))
        number = np.zeros(len(found), dtype=np.uint64)
        number[order] = place - np.maximum.accumulate(np.where(same, 0, place))
        self.values = mix(found + number * BASE)
        self.sizes = np.bincount(self.row, minlength=self.rows)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digests of some rows, with each row's place among them."""
        begin = np.searchsorted(self.row, rows, "left")
        n = self.sizes[rows]
        ends = np.cumsum(n)
        at = np.repeat(begin - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return self.values[at], np.repeat(np.arange(len(rows)), n)


def _checks(digests: np.ndarray) -> np.ndarray:
    return (mix(digests ^ BASE) >> np.uint64(32)).astype(np.uint32)


def _cells(digests: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """The three cells of each digest in its table, one third of the table each."""
    third = size // 3
    return np.stack([table * size + k * third + (mix(digests + SALTS[k]) % np.uint64(third)).astype(np.int64) for k in range(3)])


class Tables:
    """Invertible lookup tables of equal size in one array of cells."""

    def __init__(self, tables: int, size: int):
        self.size = size
        self.cells = np.zeros(tables * size, dtype=CELL)

    def add(self, digests: np.ndarray, table: np.ndarray, sign: np.ndarray | int = 1) -> None:
        sign = np.broadcast_to(np.asarray(sign, dtype=np.int64), digests.shape)
        checks = (_checks(digests) * sign.astype(np.uint32)).astype(np.uint32)
        sums = digests * sign.astype(np.uint64)
        for cell in _cells(digests, table, self.size):
            np.add.at(self.cells["count"], cell, sign.astype(np.int32))
            np.add.at(self.cells["digests"], cell, sums)
            np.add.at(self.cells["checks"], cell, checks)

    def minus(self, other: Tables) -> Tables:
        out = Tables(0, self.size)
        out.cells = np.zeros(len(self.cells), dtype=CELL)
        for name in CELL.names:
            out.cells[name] = self.cells[name] - other.cells[name]
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empties what can be: digests found, their tables and signs; then which tables are empty."""
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        at = np.flatnonzero(np.abs(self.cells["count"]) == 1)
        while len(at):
            cells = self.cells[at]
            sign = cells["count"].astype(np.int64)
            digests = cells["digests"] * sign.astype(np.uint64)
            pure = (np.abs(sign) == 1) & (_checks(digests) * sign.astype(np.uint32) == cells["checks"])
            digests, sign, table = digests[pure], sign[pure], at[pure] // self.size
            if not len(digests):
                break
            _, once = np.unique(digests + mix(table.astype(np.uint64)), return_index=True)
            digests, sign, table = digests[once], sign[once], table[once]
            self.add(digests, table, -sign)
            found.append((digests, table, sign))
            touched = np.unique(_cells(digests, table, self.size))
            at = touched[np.abs(self.cells["count"][touched]) == 1]
        left = np.zeros(len(self.cells), dtype=bool)
        for name in CELL.names:
            left |= self.cells[name] != 0
        digests, table, sign = (np.concatenate(x) for x in zip(*found, strict=True))
        return digests, table, sign, ~left.reshape(-1, self.size).any(axis=1)


def fingerprints(digests: Digests) -> Tables:
    """The smallest tables of all rows."""
    tables = Tables(digests.rows, CELLS)
    tables.add(digests.values, digests.row)
    return tables


def texts_of(tables: Tables) -> list[str]:
    """Tables as text."""
    held = tables.cells.tobytes()
    width = tables.size * CELL.itemsize
    return [base64.b64encode(held[at : at + width]).decode() for at in range(0, len(held), width)]


def differences(
    one: Digests, two: Digests, rows_one: np.ndarray, rows_two: np.ndarray, first: Tables
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests that only one of two versions has, the pair's number, and 1 or -1 for the first or second.

    ``first`` holds the subtracted fingerprints of all pairs.
    """
    out, todo, tables = [], np.arange(len(rows_one)), first
    while True:
        digests, table, sign, done = tables.peel()
        good = done[table]
        out.append((digests[good], todo[table[good]], sign[good]))
        todo = todo[~done]
        if not len(todo):
            return tuple(np.concatenate(x) for x in zip(*out, strict=True))
        size = tables.size * GROWTH
        tables = Tables(len(todo), size)
        tables.add(*one.of(rows_one[todo]))
        tables.add(*two.of(rows_two[todo]), sign=-1)


def likeness(one: np.ndarray, two: np.ndarray, pair: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Shared passages by all passages of both, for the sizes of the pairs and their differences."""
    only_one = np.bincount(pair[sign > 0], minlength=len(one))
    only_two = np.bincount(pair[sign < 0], minlength=len(one))
    union = one + only_two
    return np.where(union == 0, 1.0, (one - only_one) / np.maximum(union, 1))


def compare(versions: DataFrame, old_col: str, new_col: str, *keep: str) -> DataFrame:
    """For every row the kept columns, both fingerprints, the digests that only one has, and the likeness."""
    made = "old_fingerprint string, new_fingerprint string, only_old array<long>, only_new array<long>, likeness double"
    rows = versions.select(*keep, F.col(old_col).alias("text"), F.col(new_col).alias("new_text"))
    schema = T.StructType([*rows.select(*keep).schema.fields, *versions.sparkSession.createDataFrame([], made).schema.fields])
    arrow = arrow_schema(schema)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            old, new = Digests(batch.column("text")), Digests(batch.column("new_text"))
            old_tables, new_tables = fingerprints(old), fingerprints(new)
            same = np.arange(batch.num_rows)
            digests, pair, sign = differences(old, new, same, same, old_tables.minus(new_tables))
            lists = []
            for side in (1, -1):
                order = np.argsort(pair[sign == side], kind="stable")
                bounds = np.searchsorted(pair[sign == side][order], np.arange(batch.num_rows + 1))
                values = digests[sign == side][order].view(np.int64)
                lists.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values)))
            columns = [batch.column(name) for name in keep]
            columns += [pa.array(texts_of(old_tables)), pa.array(texts_of(new_tables)), *lists]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(likeness(old.sizes, new.sizes, pair, sign))], schema=arrow)

    return rows.mapInArrow(work, schema)


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, copy, doc_id, text), sorted, in which every document is followed by the next one.

    Buckets are ranges of ids. The first document of a bucket comes once more, as a copy, at the
    end of the bucket before it, and that of the first bucket at the end of the last.
    """
    ids = docs.select("doc_id")
    buckets = min(max(1, ids.count() // BUCKET_ROWS), MOST_BUCKETS)
    bounds = np.zeros(0, dtype=np.int64)
    if buckets > 1:
        steps = [k / buckets for k in range(1, buckets)]
        found = ids.agg(F.percentile_approx("doc_id", steps, 10 * MOST_BUCKETS).alias("at")).first()["at"]
        bounds = np.unique(np.array(found or [], dtype=np.int64))

    def numbers(values: pa.Array) -> np.ndarray:
        """Bucket of each id: the largest ids are in bucket 0, nulls in the last. Ids stay whole numbers beside nulls."""
        known = values.cast(pa.int64()).fill_null(0).to_numpy()
        absent = values.is_null().to_numpy(zero_copy_only=False)
        return np.where(absent, len(bounds), len(bounds) - np.searchsorted(bounds, known, "left"))

    @F.arrow_udf("long")
    def bucket_of(values: pa.Array) -> pa.Array:
        return pa.array(numbers(values), pa.int64())

    heads = ids.groupBy(bucket_of("doc_id").alias("bucket")).agg(F.max("doc_id").alias("head")).collect()
    heads = sorted((row["bucket"], row["head"]) for row in heads)
    before = {bucket: heads[k - 1][0] for k, (bucket, _) in enumerate(heads)}
    head_of = dict(heads)

    @F.arrow_udf("array<long>")
    def places(values: pa.Array) -> pa.Array:
        out = []
        for bucket, value in zip(numbers(values).tolist(), values.to_pylist(), strict=True):
            out.append([2 * bucket, 2 * before[bucket] + 1] if value == head_of[bucket] else [2 * bucket])
        return pa.array(out, pa.list_(pa.int64()))

    rows = docs.withColumn("place", F.explode(places("doc_id"))).withColumn("bucket", F.shiftright("place", 1))
    rows = rows.withColumn("copy", F.col("place") % 2 == 1).withColumn("text_key", F.xxhash64("text"))
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "copy", F.col("doc_id").desc_nulls_last(), "text_key")
    return ordered.select("bucket", "copy", "doc_id", "text")


def edited_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document against its edited text and against the next document, in descending order of ids.

    The edited text has the last third of the code points replaced by as many of the next
    document's first ones.
    """
    made = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    renamed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([renamed.schema["doc_id"], *docs.sparkSession.createDataFrame([], made).schema.fields])
    arrow = arrow_schema(schema)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None
        for batch in slices(batches, "text", SLICE_BYTES):
            both = pa.Table.from_batches([waiting, batch] if waiting else [batch]).combine_chunks().to_batches()[0]
            waiting = both.slice(both.num_rows - 1)
            bucket = both.column("bucket").to_numpy()
            copy = both.column("copy").to_numpy(zero_copy_only=False)
            rows = np.flatnonzero((bucket[1:] == bucket[:-1]) & ~copy[:-1])
            if not len(rows):
                continue
            text = both.column("text").to_pylist()
            edited = [text[i][: len(text[i]) - len(text[i]) // 3] + text[i + 1][: len(text[i]) // 3] for i in rows.tolist()]
            known, new = Digests(both.column("text")), Digests(pa.array(edited, pa.large_string()))
            tables, new_tables = fingerprints(known), fingerprints(new)
            near = []
            for other, other_rows, other_tables in ((new, np.arange(len(rows)), new_tables), (known, rows + 1, tables)):
                one, two = Tables(0, CELLS), Tables(0, CELLS)
                one.cells = tables.cells.reshape(-1, CELLS)[rows].ravel()
                two.cells = other_tables.cells.reshape(-1, CELLS)[other_rows].ravel()
                _, pair, sign = differences(known, other, rows, other_rows, one.minus(two))
                near.append(pa.array(likeness(known.sizes[rows], other.sizes[other_rows], pair, sign)))
            shown = texts_of(tables)
            columns = [
                both.column("doc_id").take(pa.array(rows)),
                pa.array([len(text[i]) for i in rows.tolist()], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                pa.array([shown[i] for i in rows.tolist()]),
                pa.array(texts_of(new_tables)),
                *near,
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return _in_order(renamed).mapInArrow(work, schema)
