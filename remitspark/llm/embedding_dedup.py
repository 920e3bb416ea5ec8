"""Near-duplicate vectors by counting collisions in sorted projections.

Every table sorts the vectors along a random line, within the cells that some random
hyperplanes cut space into. Around every vector as the query a window of its table is taken;
the vectors in it collide with the query. Collisions are counted per pair over all tables, and
pairs with at least ``COLLISIONS`` are verified by cosine in double precision.

The tables' number and cells follow from the number of vectors: cells get finer with more
vectors, so that a window holds about as many at any size, and there are as many tables as a pair
at the very threshold needs to pass the count with the wanted probability. A closer pair passes
more surely: at cosine 0.95 the chance to miss it is below one in ten thousand.

Equal vectors are one node with a number of copies. Defined results: a vector that is null,
empty, zero or holds a null or a value that is not finite is linked with nothing, and so is one
without an id; its component is its id. Vectors of different lengths are not linked. Rows that
share an id are vectors of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from remitspark.llm.common import stored
from remitspark.llm.components import components
from remitspark.llm.textarrays import BASE, mix

COSINE = 0.9
#: Wanted probability that a pair at the threshold is found.
RECALL = 0.98
COLLISIONS = 2
#: Half the width of a window, for unit vectors on a line with standard normal coordinates.
WINDOW = 1.0
PAIRS_AT_ONCE = 1 << 20


def plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Number of hyperplanes of a table's cells, and of tables, for ``n`` vectors."""
    planes = max(4, math.ceil(math.log2(max(n, 2))) - 4)
    spread = math.sqrt(2 * (1 - cosine))
    same_cell = (1 - math.acos(cosine) / math.pi) ** planes
    chance = same_cell * math.erf(WINDOW / spread / math.sqrt(2))
    tables = COLLISIONS
    while sum(math.comb(tables, k) * chance**k * (1 - chance) ** (tables - k) for k in range(COLLISIONS)) > 1 - recall:
        tables += 1
    return planes, tables


def _vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, vector, high, low); vector is null where it can't be linked."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), vector.alias("vector"))
    rows = rows.withColumn("vector", F.when(good, F.col("vector")))
    return rows.withColumn("high", F.xxhash64("vector")).withColumn("low", F.xxhash64(F.lit(1), "vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)  # so that no square overflows
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _entries(nodes: DataFrame, planes: int, tables: int) -> DataFrame:
    """Rows (cell, place, node): a node's cell and place on the line, in every table."""
    schema = pa.schema([("cell", pa.int64()), ("place", pa.float64()), ("node", pa.int64())])
    bits = np.uint64(1) << np.arange(planes, dtype=np.uint64)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column("vector")).to_numpy()
            for length in np.unique(lengths):
                if length not in lines:
                    lines[length] = np.random.default_rng(int(length)).standard_normal((length, tables, planes + 1))
                chosen = batch.filter(pa.array(lengths == length))
                for begin in range(0, chosen.num_rows, 1000):
                    part = chosen.slice(begin, 1000)
                    at = np.tensordot(_matrix(part.column("vector")), lines[length], axes=1)
                    codes = ((at[:, :, :planes] > 0) * bits).sum(axis=2, dtype=np.uint64)
                    which = np.arange(tables, dtype=np.uint64) + mix(np.uint64([length]))
                    cell = mix(mix(codes + BASE) ^ mix(which)).view(np.int64).ravel()
                    node = np.repeat(part.column("node").to_numpy(), tables)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(at[:, :, planes].ravel()), pa.array(node)], schema=schema)

    return nodes.select("node", "vector").mapInArrow(project, "cell long, place double, node long")


def _collisions(entries: DataFrame) -> DataFrame:
    """Rows (a, b), one for every window of every table that holds the pair."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def collide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, place, node = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            old = len(cell)
            cell, place, node = (
                np.concatenate([held, batch.column(name).to_numpy()])
                for held, name in ((cell, "cell"), (place, "place"), (node, "node"))
            )
            # Cells far apart on one axis, so that one search finds all windows.
            number = np.cumsum(np.append(0, cell[1:] != cell[:-1]))
            axis = number * 1e4 + place
            first = np.searchsorted(axis, axis - WINDOW, "left")
            later = np.arange(old, len(cell))
            counts = later - first[old:]
            ends = np.cumsum(counts)
            begin = 0
            while begin < len(later):
                stop = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS_AT_ONCE, "right"))
                stop = max(stop, begin + 1)
                n = counts[begin:stop]
                one = np.repeat(later[begin:stop], n)
                two = np.repeat(first[old:][begin:stop] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                a, b = node[one], node[two]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)
                begin = stop
            keep = (cell == cell[-1]) & (place >= place[-1] - WINDOW)
            cell, place, node = cell[keep], place[keep], node[keep]

    ordered = entries.repartition("cell").sortWithinPartitions("cell", "place")
    return ordered.mapInArrow(collide, "a long, b long")


def _verified(pairs: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """The pairs with at least this cosine."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                close = np.zeros(part.num_rows, dtype=bool)
                lengths = pa.compute.list_value_length(part.column("one")).to_numpy()
                for length in np.unique(lengths):
                    chosen = part.filter(pa.array(lengths == length))
                    dots = np.einsum("ij,ij->i", _matrix(chosen.column("one")), _matrix(chosen.column("two")))
                    close[lengths == length] = dots >= cosine
                yield part.select(["a", "b"]).filter(pa.array(close)).cast(schema)

    one = nodes.select(F.col("node").alias("a"), F.col("vector").alias("one"))
    two = nodes.select(F.col("node").alias("b"), F.col("vector").alias("two"))
    # Cells of different lengths have different hashes; a chance collision is dropped here.
    both = pairs.join(two, "b").join(one, "a").filter(F.size("one") == F.size("two"))
    return both.select("a", "b", "one", "two").mapInArrow(verify, "a long, b long")


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    rows = _vectors(vectors, id_col, vector_col)
    classes = rows.filter("vector IS NOT NULL").groupBy("high", "low")
    nodes = classes.agg(F.min("vec_id").alias("min_id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    # Written with the nodes, the numbers are the same for every later reader.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    entries = _entries(nodes, *plan(nodes.count(), cosine, recall))
    counted = _collisions(entries).groupBy("a", "b").agg(F.count("*").alias("n"))
    pairs = stored(counted.filter(F.col("n") >= COLLISIONS).select("a", "b"), "pairs")
    links = stored(_verified(pairs, nodes, cosine), "verified")

    plain = nodes.drop("vector")
    copies = plain.select(F.col("node").alias("b"), "copies")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
    rooted = plain.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("min_id").alias("component_id"))
    by_class = rooted.join(others, "node", "left").join(least, "root")
    n_links = (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    joined = rows.select("vec_id", "high", "low", F.col("vector").isNotNull().alias("good")).join(
        by_class.select("high", "low", n_links, "component_id"), ["high", "low"], "left"
    )
    component = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("good"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
