"""Connected components of a table of links: in parts first, then by iterated joins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from remitspark.llm.common import stored

#: Links that one task connects among themselves.
TASK_LINKS = 1 << 19


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, node) for all nodes of some links but the smallest of each component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while (root[one] != root[two]).any():
        low = np.minimum(root[one], root[two])
        np.minimum.at(root, root[one], low)
        np.minimum.at(root, root[two], low)
        while (root[root] != root).any():
            root = root[root]
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[other]], nodes[other]


def _thinned(links: DataFrame) -> DataFrame:
    """Links that connect the same nodes: a task gives fewer links than it has nodes."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def thin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for side, name in zip(held, ("a", "b"), strict=True):
                side.append(batch.column(name).to_numpy())
        root, node = stars(*map(np.concatenate, held))
        yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(node)], schema=schema)

    tasks = max(1, -(-links.count() // TASK_LINKS))
    return links.select("a", "b").repartition(tasks).mapInArrow(thin, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Stored rows (node, root) for stored links (a, b) of long ids; the root is the smallest node reached.

    Tasks connect half a million links each among themselves, which leaves less than a link a
    node and task. Then every round gives a node the smallest root of its neighbours and
    follows that root's own root, so that long chains need few rounds. Each round is a stored
    table: the plan stays short, and nothing is lost with an executor.
    """
    few = stored(_thinned(links), "thinned")
    both = stored(few.union(few.select("b", "a")).distinct(), "links")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    before = None
    while True:
        total = roots.agg(F.sum(F.col("root").cast("decimal(38,0)")).alias("total")).first()["total"]
        if total == before or total is None:
            return roots
        before = total
        near = (
            both.join(roots, both["b"] == roots["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = roots.join(near, "node").select("node", F.least("root", "near").alias("root"))
        onward = roots.select(F.col("node").alias("root"), F.col("root").alias("onward"))
        roots = stored(lower.join(onward, "root", "left").select("node", F.least("root", "onward").alias("root")), "roots")
