"""Packing of tokenised documents into sequences of a fixed window.

Documents are tokenised once. What remains of them are rows of piece lengths and checksums,
a few dozen bytes each, so that packing moves no text and no ids. A document fills whole
windows first; its rest is cut into parts of at most ``part`` ids. Parts are packed block by
block with the Karmarkar-Karp method for many ways: partial partitions with the largest
imbalances are merged so that the fullest window of one meets the emptiest of the other. If
a window of the result is over capacity, the block gets one window more.

Defined results: a null or empty text is a document of its end id alone; a row that occurs
twice is packed twice; null ids stay null; an empty table gives no rows. Texts of any length
are tokenised whole. Other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from remitspark.llm.common import arrow_schema, small_batches, stored
from remitspark.llm.textarrays import LOWER, Hasher, heads, slices, text_bytes, word_bounds

WINDOW = 2048
BLOCK_WINDOWS = 48
#: Every 12th rest is cut into parts of this many ids: small change that evens windows out.
SMALL_PART = 32
SMALL_EVERY = 12
#: Near-equal windows need a little room: this share of a block stays free.
ROOM = 1 / 150
END_ID = 1
#: Words and parts of words that a Python worker keeps, some 70 MB; the frequent ones come first.
CACHED_WORDS = 600_000
CACHED_PARTS = 150_000
#: Ids that one task packs.
TASK_IDS = 4 << 20


class WordIds:
    """Ids of texts. The tokenizer never joins ids over white space, so a text's ids are those
    of its words; a word's ids are kept in arrays, under a hash of its bytes together with its
    length and first bytes.

    A word of Latin letters, perhaps with ASCII marks after it, is two words to the tokenizer.
    Its stem in lower case needs the merges alone; other words go through the tokenizer whole.
    """

    PARTS = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]*)")
    #: White space that the tokenizer drops and that no id spans.
    BREAKS = np.isin(np.arange(256), [0x09, 0x0A, 0x0D, 0x20])

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        # The letter that stands for each byte.
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {i: shown(chr(i))[0][0][-1] for i in range(0x80, 0xC0)}
        self.letters |= {i: shown(chr((i & 0x1F) << 6))[0][0][0] for i in range(0xC2, 0xE0)}
        self.parts: dict[str, array] = {"": array("I")}
        self.count = 0
        slots = 4 * CACHED_WORDS
        self.slot_word = np.full(slots, -1, dtype=np.int32)
        self.keys = np.zeros((2, CACHED_WORDS), dtype=np.uint64)
        self.first = np.zeros(CACHED_WORDS + 1, dtype=np.int64)
        self.pool = np.zeros(1 << 20, dtype=np.uint32)

    def _part(self, part: str) -> array:
        ids = self.parts.get(part)
        if ids is None:
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [token.id for token in self.merges.tokenize(shown)])
            if len(self.parts) < CACHED_PARTS:
                self.parts[part] = ids
        return ids

    def _word(self, word: str) -> array:
        parts = self.PARTS.fullmatch(word)
        if parts and (word.isascii() or max(word) < "İ"):
            stem, marks = parts.groups()
            return self._part(stem.lower()) + self._part(marks)
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Number of each word among those kept, or -1."""
        slots = len(self.slot_word)
        found = np.full(len(one), -1, dtype=np.int64)
        open_, at = np.arange(len(one)), (one % np.uint64(slots)).astype(np.int64)
        while len(open_):
            word = self.slot_word[at]
            hit = (word >= 0) & (self.keys[0][word] == one[open_]) & (self.keys[1][word] == two[open_])
            found[open_[hit]] = word[hit]
            on = (word >= 0) & ~hit
            open_, at = open_[on], (at[on] + 1) % slots
        return found

    def _keep(self, one: np.ndarray, two: np.ndarray, ids: list[array]) -> None:
        """Adds new words, as many as there is room for."""
        n = min(len(ids), CACHED_WORDS - self.count)
        lengths = np.fromiter(map(len, ids[:n]), np.int64, n)
        new = np.arange(self.count, self.count + n)
        self.keys[0][new], self.keys[1][new] = one[:n], two[:n]
        self.first[new + 1] = self.first[self.count] + np.cumsum(lengths)
        end = int(self.first[self.count + n])
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(end - len(self.pool), len(self.pool)), np.uint32)])
        self.pool[int(self.first[self.count]) : end] = np.frombuffer(b"".join(ids[:n]), np.uint32)
        slots = len(self.slot_word)
        at = (one[:n] % np.uint64(slots)).astype(np.int64)
        while len(new):
            free = self.slot_word[at] < 0
            self.slot_word[at[free]] = new[free]  # of several for one slot the last one gets it
            on = self.slot_word[at] != new
            new, at = new[on], (at[on] + 1) % slots
        self.count += n

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in one array, and the offsets of the rows in it."""
        start, end, row = word_bounds(data, offsets, self.BREAKS)
        # Special tokens, which have this mark, are case sensitive; nothing else is.
        lower = not (data == ord("<")).any()
        shown = LOWER[data] if lower else data
        one, two = Hasher(shown, lower=False)(start, end), heads(shown, start, end)
        number = self._find(one, two)
        first, pool = self.first, self.pool
        missing = np.flatnonzero(number < 0)
        if len(missing):
            _, where, back = np.unique(one[missing] ^ (two[missing] << np.uint64(1)), return_index=True, return_inverse=True)
            sample = missing[where]
            text = data.tobytes()
            ids = [self._word(text[a:b].decode()) for a, b in zip(start[sample].tolist(), end[sample].tolist(), strict=True)]
            base = self.count
            if base + len(ids) > CACHED_WORDS:  # no room: these serve this call alone
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                pool = np.concatenate([self.pool[: self.first[base]], np.frombuffer(b"".join(ids), np.uint32)])
                first = np.concatenate([self.first[: base + 1], self.first[base] + np.cumsum(lengths)])
            else:
                self._keep(one[sample], two[sample], ids)
                first, pool = self.first, self.pool
            number[missing] = base + back
        counts = first[number + 1] - first[number]
        ends = np.cumsum(counts)
        flat = pool[np.repeat(first[number] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        per_row = np.bincount(row, weights=counts, minlength=len(offsets) - 1).astype(np.int64)
        return flat, np.concatenate([[0], np.cumsum(per_row)])


_tokenizers: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, kept by the Python worker with the words it knows."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def cut(n: int, window: int, small: bool) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: whole windows, then the rest, if asked in small parts."""
    whole = n - n % window
    for start in range(0, whole, window):
        yield start, window
    step = SMALL_PART if small else window
    for start in range(whole, n, step):
        yield start, min(step, n - start)


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str, window: int = WINDOW
) -> DataFrame:
    """One row per piece of a document: id, start, length, ids_crc32, doc_tokens."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]
    )
    arrow = arrow_schema(schema)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer).of
        for batch in slices(batches, "text"):
            row, rows = [], []
            flat, bounds = ids_of(*text_bytes(batch.column("text")))
            for i, (begin, stop) in enumerate(pairwise(bounds.tolist())):
                ids = flat[begin:stop]
                n = len(ids) + 1
                small = zlib.crc32(ids) % SMALL_EVERY == 0
                for start, length in cut(n, window, small):
                    crc = zlib.crc32(ids[start : start + length])
                    row.append(i)
                    rows.append((start, length, zlib.crc32(end, crc) if start + length == n else crc, n))
            numbers = np.array(rows, dtype=np.int64).reshape(-1, 4)
            ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(numbers[:, k]) for k in range(4)]], schema=arrow)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tokenise, schema)


def difference(lengths: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: indexes of the lengths, in ``ways`` groups of nearly equal sums."""
    if ways == 1:
        return [list(range(len(lengths)))]
    heap = []
    for i, length in enumerate(lengths):
        sums = np.zeros(ways, dtype=np.int64)
        sums[0] = length
        heap.append((-length, i, sums, [[i], *[[] for _ in range(ways - 1)]]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, sums, groups = heapq.heappop(heap)
        _, order, more, others = heapq.heappop(heap)
        sums = sums + more[::-1]  # the largest of one on the smallest of the other
        groups = [a + b for a, b in zip(groups, reversed(others), strict=True)]
        place = np.argsort(-sums, kind="stable")
        sums = sums[place]
        sums -= sums[-1]
        heapq.heappush(heap, (-int(sums[0]), order, sums, [groups[k] for k in place]))
    return heap[0][3] if heap else []


def pack_block(lengths: list[int], window: int) -> list[list[int]]:
    """Indexes of the lengths, by window; none over capacity."""
    ways = -(-sum(lengths) // window)
    while True:
        groups = difference(lengths, ways)
        if all(sum(lengths[i] for i in group) <= window for group in groups):
            return [group for group in groups if group]
        ways += 1


def blocks(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of lengths with a sum of at most ``limit``."""
    begin, ends = 0, np.cumsum(lengths)
    while begin < len(lengths):
        end = int(np.searchsorted(ends, limit + (ends[begin - 1] if begin else 0), side="right"))
        yield begin, max(end, begin + 1)
        begin = max(end, begin + 1)


def pack(cut_pieces: DataFrame, *, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, task_ids: int = TASK_IDS) -> DataFrame:
    """The pieces with sequence_id and offset. ``cut_pieces`` should be a stored table.

    Rows are dealt evenly to tasks whatever their ids are. A task holds one block of pieces
    at a time. Its last block, which may be small, is the only one with a window to fill up.
    """
    schema = T.StructType([*cut_pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    arrow = arrow_schema(schema)
    limit = int(block_windows * window * (1 - ROOM))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        waiting: pa.Table | None = None

        def placed(table: pa.Table, groups: list[list[int]]) -> pa.Table:
            nonlocal sequence
            lengths = table.column("length").to_numpy()
            order = np.fromiter((i for g in groups for i in g), np.int64)
            ids = np.repeat(np.arange(len(groups)) + sequence, [len(g) for g in groups])
            offsets = np.concatenate([np.cumsum(lengths[g]) - lengths[g] for g in map(np.array, groups)])
            sequence += len(groups)
            columns = [*table.take(pa.array(order)).columns, pa.array(ids), pa.array(offsets)]
            return pa.Table.from_arrays(columns, schema=arrow)

        def packed(table: pa.Table, last: bool) -> Iterator[pa.Table]:
            """Packs whole blocks; what is not a whole block waits."""
            nonlocal waiting
            lengths = table.column("length").to_numpy()
            waiting = None
            for begin, end in blocks(lengths, limit):
                if end == len(lengths) and not last:
                    waiting = table.slice(begin)
                else:
                    part = table.slice(begin, end - begin)
                    yield placed(part, pack_block(lengths[begin:end].tolist(), window))

        for batch in small_batches(batches, 8192):
            table = pa.Table.from_batches([batch])
            full = pa.compute.equal(table.column("length"), window)
            whole = table.filter(full)
            if whole.num_rows:
                yield from placed(whole, [[i] for i in range(whole.num_rows)]).to_batches()
            rest = table.filter(pa.compute.invert(full))
            if rest.num_rows:
                for out in packed(pa.concat_tables([waiting, rest]) if waiting else rest, last=False):
                    yield from out.to_batches()
        if waiting:
            for out in packed(waiting.combine_chunks(), last=True):
                yield from out.to_batches()

    total = cut_pieces.agg(F.sum("length").alias("ids")).first()["ids"] or 0
    return cut_pieces.repartition(max(1, -(-total // task_ids))).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, *, tokenizer: str, window: int = WINDOW, **names: str) -> DataFrame:
    """Pieces of all documents with their place in the sequences."""
    cut_pieces = pieces(docs, tokenizer=tokenizer, window=window, **names)
    return pack(stored(cut_pieces, "pieces"), window=window)
