"""Whole batches of texts as arrays of bytes: word bounds, word hashes, shingles.

Functions for use inside tasks. A batch of texts is one byte array plus row offsets; words are
found and hashed for all rows at once, so that no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Arrays of a slice take some fifty times as much memory as its text.
SLICE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)

#: The white space that separates words, 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
#: Bytes outside of words made of letters: ASCII other than letters.
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: A 64-bit value for every byte value.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def unit_floats(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as floats in the open interval from 0 to 1."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again in slices with about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        offsets = text_bytes(batch.column(column))[1]
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()  # workers outlive their tasks


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and the offsets of the rows in them. Null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and row of every word; no word spans rows."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~outside[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for positions 0 to n."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        base = int(BASE) | 1
        inverse = pow(base, -1, 1 << 64)
        for name, factor in (("up", base), ("down", inverse)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


class Hasher:
    """Hashes of any byte ranges of a batch, from one prefix sum over its bytes."""

    def __init__(self, data: np.ndarray, lower: bool = True):
        up, self.down = _power_tables(len(data))
        values = BYTE_VALUES[LOWER[data] if lower else data]
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(data)], out=self.sums[1:], dtype=np.uint64)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the ranges; equal bytes have equal hashes wherever they stand."""
        spread = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(spread + (end - start).astype(np.uint64))


def heads(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first seven bytes of each range, and its length modulo 256, in one value."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    length = end - start
    keep = np.array([(1 << 8 * k) - 1 for k in range(8)], dtype=np.uint64)[np.minimum(length, 7)]
    return (words[start] & keep) | ((length & 255).astype(np.uint64) << np.uint64(56))


def row_ranges(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``n`` rows begins and ends in a sorted array of row numbers."""
    return np.searchsorted(rows, np.arange(n), "left"), np.searchsorted(rows, np.arange(n), "right")


def shingles(hashes: np.ndarray, rows: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``words`` neighbouring words of a row, and their rows.

    A row with fewer words gives one shingle of all of them.
    """
    n = len(hashes)
    if n == 0:
        return hashes, rows
    joined = mix(hashes ^ BASE)
    left = np.searchsorted(rows, rows, "right") - np.arange(n)  # words from here to the row's end
    is_head = np.ones(n, dtype=bool)
    is_head[1:] = rows[1:] != rows[:-1]
    whole = np.where(is_head & (left < words), left, 0)
    values, where = [joined[whole == 1]], [rows[whole == 1]]
    for k in range(1, words):
        rotated = (joined << np.uint64(29)) | (joined >> np.uint64(35))
        joined = mix(rotated[: n - k] * np.uint64(3) + hashes[k:])
        if k + 1 < words:
            short = whole[: n - k] == k + 1
            values.append(joined[short])
            where.append(rows[: n - k][short])
    full = left[: len(joined)] >= words
    values.append(joined[full])
    where.append(rows[: len(joined)][full])
    where = np.concatenate(where)
    order = np.argsort(where, kind="stable")
    return np.concatenate(values)[order], where[order]


class Passages:
    """Lines of a batch, cut at places that depend on the words nearby alone.

    A cut stands before a word whose pair with the next word has a smaller hash than the pairs
    of the ``reach`` words before and after it in the line. So a passage that is copied into
    the middle of another line has the same cuts there, but for its edges.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, reach: int):
        self.word_start, self.word_end, row = word_bounds(data, offsets)
        hashes = Hasher(data)(self.word_start, self.word_end)
        n = len(hashes)
        line = np.searchsorted(np.flatnonzero(data == 10), self.word_start) + row  # grows with every line and row
        order = mix(hashes)  # the last word of a line has no next one
        paired = line[1:] == line[:-1]
        order[:-1][paired] = mix(hashes[:-1] * np.uint64(3) + hashes[1:])[paired]
        head = np.ones(n, dtype=bool)
        head[1:] = line[1:] != line[:-1]
        cut = np.ones(n, dtype=bool)
        for k in range(1, reach + 1):
            near = line[k:] == line[:-k]
            cut[k:] &= near & (order[k:] < order[:-k])
            cut[:-k] &= near & (order[:-k] < order[k:])
            cut[:k] = False
            cut[max(n - k, 0) :] = False
        self.first = np.flatnonzero(cut | head)  # number of the first word of each passage
        self.after = np.append(self.first[1:], n)
        self.row = row[self.first] if n else row
        # Whether the passage that follows is in the same line.
        self.in_line = np.append(line[self.first[1:]] == line[self.first[:-1]], False)[: len(self.first)]
        up, down = _power_tables(n)
        self.digests = []
        for salt in (BASE, ~BASE):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + salt) * up[:n], dtype=np.uint64)])
            spread = (sums[self.after] - sums[self.first]) * down[self.first]
            self.digests.append(mix(spread + (self.after - self.first).astype(np.uint64)))

    @property
    def words(self) -> np.ndarray:
        return self.after - self.first


def char_positions(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of code points before each byte, over the whole batch."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
