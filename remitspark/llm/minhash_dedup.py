"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of sub-keys are made from minhashes, and every pair of a sub-key of one
and a sub-key of the other is the key of a hash table: 9 and 12 sub-keys from 54 minhashes
serve 108 tables, which would take 540 minhashes one by one. Two sets of similarity 0.8 share no
table with probability 0.0003, of 0.85 with 0.00001.

Documents with equal shingle sets are one class, found by a grouping; only classes take part
in what follows. Classes with one key in a table are candidates if two bits of enough of their
minhashes agree. Families of classes that candidates connect are then linked by exact counts on
full shingle sets: a class outside the largest component of its family is compared with all
others at once, so that a large group of near copies costs a few comparisons and gives
one link a member. Large families are compared block by block, in as many tasks.

Defined results: a null or empty text has an empty set and is linked with nothing. A document
without an id is never linked: its component_id is null and it is kept. Rows that share an id
are compared each with its own text. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from remitspark.llm.common import arrow_schema, stored
from remitspark.llm.components import components
from remitspark.llm.textarrays import BASE, Hasher, mix, row_ranges, shingles, slices, text_bytes, word_bounds
from remitspark.tables import fits_broadcast

#: Minhashes in a sub-key and number of sub-keys, for both collections.
COLLECTIONS = ((2, 9), (3, 12))
SIMILARITY = 80
HASHES = sum(size * count for size, count in COLLECTIONS)
FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * BASE) | np.uint64(1)
FLIPS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) + BASE)
#: Of the 54 minhashes so many agree in two bits, by chance or not, for all but one in 200,000 of
#: the pairs of similarity 0.8 that share a key.
ALIKE = 35
RUN_ROWS = 100_000
#: Bytes of sets in a block; a task holds two blocks, with some ten times as much memory.
BLOCK_BYTES = 2 << 20
#: Classes of a large family that all its blocks are compared with.
LEADERS = 16


def _row_shingles(batch: pa.RecordBatch, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of a batch, and where each row's begin and end."""
    data, offsets = text_bytes(batch.column("text"))
    start, end, row = word_bounds(data, offsets)
    found, rows = shingles(Hasher(data)(start, end), row, words)
    return found, *row_ranges(rows, batch.num_rows)


def _set_digest(members: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed values."""
    high = mix(members + BASE).sum(dtype=np.uint64)
    low = mix(members ^ FLIPS[0]).sum(dtype=np.uint64)
    return int(high.view(np.int64)), int(low.view(np.int64))


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Per document: doc_id, n_shingles, digest of the set (high, low), minhashes."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("n_shingles", "high", "low")]
        + [T.StructField("minhashes", T.BinaryType())]
    )
    arrow = arrow_schema(schema)

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, begin, end = _row_shingles(batch, words)
            hashes = np.zeros((batch.num_rows, HASHES), dtype=np.uint32)
            filled = end > begin
            if len(found):
                for k in range(HASHES):
                    values = (((found ^ FLIPS[k]) * FACTORS[k]) >> np.uint64(32)).astype(np.uint32)
                    hashes[filled, k] = np.minimum.reduceat(values, begin[filled])
            numbers = np.zeros((batch.num_rows, 3), dtype=np.int64)
            for i in np.flatnonzero(filled):
                members = np.unique(found[begin[i] : end[i]])
                numbers[i] = len(members), *_set_digest(members)
            packed = pa.array([hashes[i].tobytes() for i in range(batch.num_rows)], pa.binary())
            columns = [batch.column("doc_id"), *[pa.array(numbers[:, k]) for k in range(3)], packed]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(sketch, schema)


def table_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of all tables for rows of minhashes: one column per pair of sub-keys."""
    subkeys, column = [], 0
    for size, count in COLLECTIONS:
        keys = np.zeros((len(hashes), count), dtype=np.uint64)
        for _ in range(size):
            keys = mix(keys * np.uint64(5) + hashes[:, column : column + count].astype(np.uint64) + BASE)
            column += count
        subkeys.append(keys)
    tables = np.arange(subkeys[0].shape[1] * subkeys[1].shape[1], dtype=np.uint64)
    pairs = subkeys[0][:, :, None] * np.uint64(3) + subkeys[1][:, None, :]
    return mix(pairs.reshape(len(hashes), -1) ^ mix(tables))


def bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last two bits of all minhashes, half of them in each of two values a row."""
    fields = (hashes & np.uint32(3)).astype(np.uint64)
    half = HASHES // 2
    shifts = np.arange(half, dtype=np.uint64) * np.uint64(2)
    return tuple((part << shifts).sum(axis=1, dtype=np.uint64) for part in (fields[:, :half], fields[:, half:]))


def agreeing(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many minhashes of two rows agree in their last two bits."""
    differing = 0
    for x, y in zip(one, two, strict=True):
        z = x ^ y
        differing = differing + np.bitwise_count((z | (z >> np.uint64(1))) & np.uint64(0x5555555555555555))
    return HASHES - differing.astype(np.int64)


def _keys(classes: DataFrame) -> DataFrame:
    names = ("key", "node", "low_bits", "high_bits")
    arrow = pa.schema([(name, pa.int64()) for name in names])

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                hashes = np.frombuffer(b"".join(part.column("minhashes").to_pylist()), np.uint32).reshape(-1, HASHES)
                keys = table_keys(hashes)
                same = [np.repeat(x.view(np.int64), keys.shape[1]) for x in (part.column("node").to_numpy(), *bits(hashes))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys.ravel().view(np.int64), *same)], schema=arrow)

    return classes.select("node", "minhashes").mapInArrow(emit, ", ".join(f"{name} long" for name in names))


def _led(run: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Within runs of rows, pairs of rows that connect those with minhashes alike; and which rows lead.

    The first row of a run leads, then the first that is unlike all leaders before, and so on.
    Every leader is compared with all rows of its run, and paired with one row of each set of
    rows that it connects: a run has fewer pairs than rows.
    """
    n = len(run)
    begin = np.flatnonzero(np.append(True, run[1:] != run[:-1])[:n])
    size = np.diff(np.append(begin, n))
    free, leads, label = np.ones(n, dtype=bool), np.zeros(n, dtype=bool), np.arange(n)
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    while len(begin):
        ends = np.cumsum(size)
        rows = np.repeat(begin - (ends - size), size) + np.arange(ends[-1])
        of = np.repeat(np.arange(len(begin)), size)
        waiting = np.flatnonzero(free[rows])
        _, first = np.unique(of[waiting], return_index=True)  # every run here has a free row
        leader = rows[waiting[first]]
        led = leader[of]
        alike = agreeing((low[rows], high[rows]), (low[led], high[led])) >= ALIKE
        free[rows[alike]] = False
        leads[leader] = True
        # A set of connected rows is known by its smallest row.
        sets, at = np.unique(label[rows[alike]], return_index=True)
        runs = of[alike][at]
        other = sets != label[leader][runs]
        pairs.append((leader[runs][other], sets[other]))
        smallest = np.full(len(begin), n)
        np.minimum.at(smallest, runs, sets)
        renamed = np.arange(n)
        renamed[sets] = smallest[runs]
        label[rows] = renamed[label[rows]]
        left = np.add.reduceat(free[rows].astype(np.int64), ends - size) > 0
        begin, size = begin[left], size[left]
    leaders, members = (np.concatenate(x) for x in zip(*pairs, strict=True))
    return leaders, members, np.flatnonzero(leads)


def _collisions(keys: DataFrame) -> DataFrame:
    """Rows (a, b) that connect the classes that share a key and most minhashes.

    A run longer than ``RUN_ROWS`` is worked on in parts. Its leaders go from part to part and
    are all connected, so that none of its rows is in a family without the others.
    """
    names = ("a", "b")
    arrow = pa.schema([(name, pa.int64()) for name in names])
    columns = ("key", "node", "low_bits", "high_bits")

    def collide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, is_long = [np.zeros(0, np.int64)] * 4, False

        def found(parts: list[np.ndarray], first_is_long: bool) -> tuple[pa.RecordBatch, np.ndarray]:
            key, node, low, high = parts
            new = np.append(True, key[1:] != key[:-1])
            rows = np.flatnonzero(~new | np.append(key[1:] == key[:-1], False))
            leader, member, leads = _led(np.cumsum(new)[rows], low[rows].view(np.uint64), high[rows].view(np.uint64))
            if first_is_long:
                chain = leads[key[rows[leads]] == key[0]]
                leader, member = np.append(leader, chain[:-1]), np.append(member, chain[1:])
            return pa.RecordBatch.from_arrays([pa.array(node[rows[leader]]), pa.array(node[rows[member]])], schema=arrow), rows[leads]

        for batch in batches:
            if batch.num_rows == 0:
                continue
            parts = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, columns, strict=True)]
            last = int(np.searchsorted(parts[0], parts[0][-1], "left"))  # keys are in order
            if last:
                yield found([x[:last] for x in parts], is_long)[0]
                is_long = False
            held = [x[last:] for x in parts]
            if len(held[0]) > RUN_ROWS:
                out, leads = found(held, True)
                yield out
                held, is_long = [x[leads] for x in held], True
        if len(held[0]):
            yield found(held, is_long)[0]

    ordered = keys.repartition("key").sortWithinPartitions("key", "node")
    return ordered.mapInArrow(collide, ", ".join(f"{name} long" for name in names))


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: DataFrame) -> DataFrame:
    """Rows (node, members) for the wanted classes (node, min_id, high, low), from one document of each."""
    arrow = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("members", pa.list_(pa.int64()))])

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, begin, end = _row_shingles(batch, words)
            members = [np.unique(found[b:e]) for b, e in zip(begin, end, strict=True)]
            digests = np.array([_set_digest(m) for m in members], dtype=np.int64).reshape(-1, 2)
            lists = pa.array([m.view(np.int64) for m in members], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0]), pa.array(digests[:, 1]), lists], schema=arrow)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # The ids wanted grow with the documents: always a shuffle, not a broadcast at small sizes.
    texts = texts.join(wanted.select(F.col("min_id").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    found = texts.select("text").mapInArrow(collect, "high long, low long, members array<long>")
    found = found.join(wanted.select("node", "high", "low"), ["high", "low"])
    return found.groupBy("node").agg(F.first("members").alias("members"))


def linked(sizes: np.ndarray, members: np.ndarray, similarity: int) -> list[tuple[int, int]]:
    """Links that connect all sets of a group that are connected by similar pairs, by exact counts.

    ``members`` holds the sets one after another. A set is compared with all others at once,
    through the sets that hold each of its members. Sets of the largest component found so far
    need not be: a link out of it is found from its other end.
    """
    n = len(sizes)
    ends = np.cumsum(sizes)
    _, ids = np.unique(members, return_inverse=True)
    holder = np.repeat(np.arange(n), sizes)[np.argsort(ids, kind="stable")]
    held = np.bincount(ids)
    first = np.cumsum(held) - held
    label, done, links = np.arange(n), np.zeros(n, dtype=bool), []
    while True:
        counts = np.bincount(label, minlength=n)
        open_ = np.flatnonzero(~done & (label != np.argmax(counts)) if n > 1 else [])
        if not len(open_):
            return links
        for i in open_[: 1 if not done.any() else 32].tolist():
            mine = ids[ends[i] - sizes[i] : ends[i]]
            lengths = held[mine]
            stops = np.cumsum(lengths)
            shared = np.bincount(holder[np.repeat(first[mine] - (stops - lengths), lengths) + np.arange(stops[-1])], minlength=n)
            near = np.flatnonzero(100 * shared >= similarity * (sizes[i] + sizes - shared))
            done[i] = True
            labels, at = np.unique(label[near], return_index=True)
            if len(labels) > 1:
                links += [(i, j) for j in near[at].tolist() if label[j] != label[i]]
                label[np.isin(label, labels)] = labels[0]


def _compared(dealt: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) that connect the similar classes among the rows (task, node, members) of each task."""
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "task"):
            column = table.column("members").combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            sizes = pa.compute.list_value_length(column).to_numpy().astype(np.int64)
            found = np.array(linked(sizes, column.flatten().to_numpy(), similarity), dtype=np.int64).reshape(-1, 2)
            node = table.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]])], schema=arrow)

    rows = dealt.select("task", "node", "members").repartition("task").sortWithinPartitions("task")
    return rows.mapInArrow(compare, "a long, b long").filter("a <> b")


def _blocks() -> Column:
    """Number of blocks for rows with members."""
    return F.ceil(F.sum(F.size("members") * 8 + 64) / BLOCK_BYTES).cast("int")


def _block_of(node: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")


def _all(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def _links(collisions: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Confirmed links (a, b) that connect classes in the families that shared keys make of them.

    A family that is too large for a task is cut into blocks. First every block is compared within
    itself and with a few classes that lead the family. Most of a family of near copies is one
    component then. Each class outside of the largest one is compared with all blocks, itself in blocks:
    two similar classes are both in the largest component, or meet in a task.
    """
    families = components(collisions).select("node", F.col("root").alias("family"))
    held = stored(families.join(sets, "node"), "families")
    counted = stored(held.groupBy("family").agg(_blocks().alias("blocks")), "family-blocks")
    counted = F.broadcast(counted) if fits_broadcast(counted) else counted
    held = held.join(counted, "family").withColumn("block", _block_of("node", "blocks"))

    large = held.filter("blocks > 1")
    place = F.row_number().over(Window.partitionBy("family").orderBy("node"))
    leaders = large.withColumn("place", place).filter(F.col("place") <= LEADERS).drop("place")
    copies = leaders.withColumn("other", _all("blocks")).filter("other <> block").withColumn("block", F.col("other")).drop("other")
    dealt = held.unionByName(copies).withColumn("task", F.xxhash64("family", "block"))
    links = stored(_compared(dealt, similarity), "led")
    if large.isEmpty():
        return links

    roots = components(stored(links.join(large.select(F.col("node").alias("a")), "a", "left_semi"), "large"))
    placed = stored(large.select("node", "family").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    sizes = placed.groupBy("family", "root").count()
    largest = sizes.groupBy("family").agg(F.max_by("root", F.struct("count", "root")).alias("root"))
    outside = placed.join(largest, ["family", "root"], "left_anti").select("node")
    queries = large.join(outside, "node", "left_semi").select("family", "node", "members", "blocks")
    parts = queries.groupBy("family").agg(_blocks().alias("parts"))
    queries = queries.join(parts, "family").withColumn("part", _block_of("node", "parts")).withColumn("block", _all("blocks"))
    others = large.join(parts, "family").withColumn("part", _all("parts"))
    both = queries.select("family", "block", "part", "node", "members").unionByName(others.select("family", "block", "part", "node", "members"))
    dealt = both.withColumn("task", F.xxhash64("family", "block", "part"))
    return stored(links.unionByName(_compared(dealt, similarity)), "confirmed")


def _groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows with one value of a sorted column at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        values = table.column(key).to_numpy()
        bounds = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for begin, end in pairwise(bounds):
            if held and held[-1].column(key)[0].as_py() != values[begin]:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(begin, end - begin))
    if held:
        yield pa.concat_tables(held)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int, similarity: int = SIMILARITY
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    found = stored(sketches(docs, id_col, text_col, words), "sketches")
    named = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("high", "low").agg(F.min("doc_id").alias("min_id"), F.first("minhashes").alias("minhashes"))
    # Written with the classes, the numbers are the same for every later reader.
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    collisions = stored(_collisions(_keys(classes)), "collisions")
    in_pairs = collisions.select(F.col("a").alias("node")).union(collisions.select("b")).distinct()
    wanted = classes.drop("minhashes").join(in_pairs, "node", "left_semi")
    sets = stored(_sets(docs, id_col, text_col, words, stored(wanted, "wanted")), "sets")
    roots = components(_links(collisions, sets, similarity))

    rooted = classes.drop("minhashes").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("min_id").alias("component_id"))
    by_class = rooted.join(least, "root").select("high", "low", "component_id")
    joined = found.drop("minhashes").join(by_class, ["high", "low"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept(component).alias("kept"))


def kept(component: Column) -> Column:
    return F.col("doc_id").eqNullSafe(component)
