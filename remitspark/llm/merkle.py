"""Merkle manifest of a table: one tree of hashes per group, and one over the groups' roots.

A row's leaf is the hash of its fields. Per group the leaves stand in ascending order of id; runs of
``FANOUT`` neighbours become the hash of their digests, until one is left, the group's subroot. The
subroots, in order of the groups, form a tree in the same way; its root names the whole table.

The trees are cut into superblocks of ``FANOUT ** LEVELS`` neighbours. Going up, a superblock becomes
one node of the next tier, so a tier has thousands of times fewer nodes than the one below. Going
down, the nodes of a superblock are cogrouped with the one row that it needs from outside, the
siblings on the way from its top to the root; one call of ``applyInPandas`` builds the levels inside
again, joins both parts of every proof, and folds leaves up to the root. So a group of any size is
many groups of bounded size, and a leaf is shuffled three times: into order, up and down.

Defined results: a field is ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value as text.
Null groups form a tree of their own, before all others; groups stand in the order of their UTF-8
bytes. Null ids come first, rows with one id in the order of their leaves; repeated rows have equal
leaves in neighbouring places. An altered row folds from its altered leaf. A lone leaf of a lone group
is the root, and its proof the hash of nothing. Texts of any length are hashed whole, where they
are read. Ids must be of a type that its text restores (integers, strings, decimals, dates). An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from remitspark.llm.common import stored

FANOUT = 8
#: Levels inside a superblock, which has 4,096 nodes.
LEVELS = 4
#: Leaves that one task puts in order.
TASK_LEAVES = 1 << 18

NODES = "tree string, place long, digest string"
PATHS = "tree string, block long, before array<string>, after array<string>, subroot string, root string"
PROOFS = "doc_key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(nodes: int, most: int) -> int:
    """Levels above so many nodes, within a superblock at most."""
    levels = 0
    while levels < most and FANOUT**levels < nodes:
        levels += 1
    return levels


def levels_above(digests: list[str], levels: int) -> list[list[str]]:
    """The digests and the levels above them."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[k : k + FANOUT])) for k in range(0, len(below), FANOUT)])
    return out


def siblings(levels: list[list[str]], at: int) -> Iterator[tuple[str, str]]:
    """Digests before and after the node in its run, on every level below the top."""
    for level in levels[:-1]:
        begin = at - at % FANOUT
        yield "".join(level[begin:at]), "".join(level[at + 1 : begin + FANOUT])
        at //= FANOUT


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """The nodes with ``place``, their number in their tree, and ``nodes``, how many it has.

    Ranges of the order are sorted each by itself; what comes before a range is a sum over the
    ranges' counts, of which there are as many as ranges and trees.
    """
    tasks = max(1, -(-nodes.count() // TASK_LEAVES))
    ranged = nodes.repartitionByRange(tasks, "tree", *order).sortWithinPartitions("tree", *order)
    seated = stored(ranged.withColumn("seat", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright("seat", 33).alias("task")
    runs = seated.groupBy("tree", task).agg(F.min("seat").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    runs = stored(runs.select("tree", "task", (begins - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("nodes")), "runs")
    placed = seated.withColumn("task", task).join(runs, ["tree", "task"])
    return placed.withColumn("place", F.col("seat") + F.col("shift")).drop("seat", "task", "shift")


def _tiers(nodes: DataFrame, depth_of_block: int) -> list[DataFrame]:
    """Tables (tree, place, digest, nodes), each of the superblocks of the one before; one node a tree in the last."""

    def top(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        levels = levels_above(block["digest"].tolist(), depth(int(block["nodes"].iloc[0]), depth_of_block))
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "digest": levels[-1]})

    size = FANOUT**depth_of_block
    tiers = [nodes]
    while True:
        below = tiers[-1]
        sizes = below.select("tree", F.ceil(F.col("nodes") / size).alias("nodes")).distinct()
        blocks = below.withColumn("block", F.floor(F.col("place") / size))
        above = blocks.select("tree", "place", "digest", "nodes", "block").groupBy("tree", "block").applyInPandas(top, NODES)
        tiers.append(stored(above.join(stored(sizes, "sizes"), "tree"), "tier"))
        if tiers[-1].filter("nodes > 1").isEmpty():
            return tiers


def _paths(tier: DataFrame, outer: DataFrame, depth_of_block: int) -> DataFrame:
    """For every node of a tier the way to the root. ``outer`` has the ways of the tier's superblocks."""

    def work(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes, way = nodes.sort_values("place"), above.iloc[0]
        levels = levels_above(nodes["digest"].tolist(), depth(int(nodes["nodes"].iloc[0]), depth_of_block))
        inner = [list(zip(*siblings(levels, at), strict=True)) or [(), ()] for at in range(len(nodes))]
        return pd.DataFrame(
            {
                "tree": key[0],
                "block": nodes["place"].to_numpy(),
                "before": [[*before, *way["before"]] for before, _ in inner],
                "after": [[*after, *way["after"]] for _, after in inner],
                "subroot": way["subroot"],
                "root": way["root"],
            }
        )

    return _cogrouped(tier.select("tree", "place", "digest", "nodes"), outer, depth_of_block).applyInPandas(work, PATHS)


def _proofs(leaves: DataFrame, outer: DataFrame, depth_of_block: int) -> DataFrame:
    """For every leaf its proof, and the root folded from its altered self."""

    def work(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes, way = nodes.sort_values("place"), above.iloc[0]
        digests = nodes["digest"].tolist()
        levels = levels_above(digests, depth(int(nodes["nodes"].iloc[0]), depth_of_block))
        outside = list(zip(way["before"], way["after"], strict=True))
        proofs, folded = [], []
        for at, altered in enumerate(nodes["altered"].tolist()):
            whole = [*siblings(levels, at), *outside]
            proofs.append(digest("".join(before + after for before, after in whole)))
            for before, after in whole:
                altered = digest(before + altered + after)
            folded.append(altered)
        out = pd.DataFrame({"doc_key": nodes["doc_key"].to_numpy(), "leaf": digests})
        out["subroot"], out["root"], out["proof_sha256"], out["folded_root"] = way["subroot"], way["root"], proofs, folded
        return out.assign(verified=out["folded_root"] == out["root"])

    rows = leaves.select("tree", "place", "digest", "nodes", "doc_key", "altered")
    return _cogrouped(rows, outer, depth_of_block).applyInPandas(work, PROOFS)


def _cogrouped(nodes: DataFrame, outer: DataFrame, depth_of_block: int) -> PandasCogroupedOps:
    block = F.floor(F.col("place") / FANOUT**depth_of_block).alias("block")
    return nodes.withColumn("block", block).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))


def _downward(tiers: list[DataFrame], outer: DataFrame, depth_of_block: int) -> DataFrame:
    """Ways from all superblocks of the lowest tier, given those from the trees' tops."""
    for tier in reversed(tiers[1:-1]):
        outer = stored(_paths(tier, outer, depth_of_block), "paths")
    return outer


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    tree_col: str = "lang",
    altered: dict[str, Column] | None = None,
    *,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``altered`` gives other values for some fields, against which the manifest is verified.
    """
    # A group's key: null comes before all others, and no key of a group is empty.
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    rows = docs.select(
        tree.alias("tree"),
        F.col(id_col).alias("doc_id"),
        leaf([F.col(name) for name in fields]).alias("digest"),
        leaf([(altered or {}).get(name, F.col(name)) for name in fields]).alias("altered"),
        F.monotonically_increasing_id().alias("tie"),  # tells repeated rows apart, so that many of them are many ranges
    )
    rows = _numbered(stored(rows, "leaves"), "doc_id", "digest", "tie")
    leaves = rows.select("tree", "place", "digest", "nodes", F.col("doc_id").cast("string").alias("doc_key"), "altered")
    tiers = _tiers(leaves, levels)

    subroots = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    subroots = _numbered(subroots, "group")
    over = _tiers(subroots, levels)
    alone = F.array().cast("array<string>")
    top = over[-1].select("tree", F.lit(0).cast("long").alias("block"), alone.alias("before"), alone.alias("after"))
    top = top.withColumn("subroot", F.lit("")).join(over[-1].select("tree", F.col("digest").alias("root")), "tree")
    ways = _paths(subroots, _downward(over, top, levels), levels).select(F.col("block").alias("place"), "before", "after", "root")
    named = subroots.select(F.col("group").alias("tree"), "place", F.col("digest").alias("subroot"))
    outer = named.join(ways, "place").select("tree", F.lit(0).cast("long").alias("block"), "before", "after", "subroot", "root")

    proofs = _proofs(leaves, _downward(tiers, stored(outer, "ways"), levels), levels)
    return proofs.select(F.col("doc_key").cast(docs.schema[id_col].dataType).alias("doc_id"), *proofs.columns[1:])


def lowered(text: Column) -> Column:
    """The text with A to Z in lower case, and nothing else changed."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def _oracle() -> str:
    """The same manifest level by level: eight levels for groups of up to 8 ** 8 rows, four for up to 8 ** 4 groups."""
    steps = [
        """WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_prepend(i::UBIGINT, list_transform(range(8), lambda k: k::UBIGINT)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS tab
), keyed AS (
    SELECT *, xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT) % 3 = 0 AS hit
    FROM documents, crc
), fielded AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, hit, text, """
        + " || ".join(
            f"coalesce(octet_length(encode({name}::VARCHAR)) || ':' || {name}, '-')" for name in ("doc_id", "source", "lang", "n_chars")
        )
        + """ AS head
    FROM keyed
), hashed AS (
    SELECT doc_id, tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(octet_length(encode(text)) || ':' || CASE WHEN hit
            THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS altered
    FROM fielded
), seated AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
), a0 AS (
    SELECT tree, place, leaf AS digest FROM seated
)"""
    ]

    def level(name: str, k: int) -> str:
        run = f"WINDOW run AS (PARTITION BY tree, place // {FANOUT} ORDER BY place"
        return f"""{name}s{k} AS (
    SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS open,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name}{k} {run})
), {name}{k + 1} AS (
    SELECT tree, place // {FANOUT} AS place,
        CASE WHEN any_value(open) THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE any_value(digest) END AS digest
    FROM {name}s{k} GROUP BY tree, place // {FANOUT}
)"""

    def fold(name: str, k: int) -> str:
        return f"""{name}f{k + 1} AS (
    SELECT f.* EXCLUDE (spot, proof, folded), spot // {FANOUT} AS spot, proof || s.before || s.after AS proof,
        CASE WHEN open THEN sha256(s.before || folded || s.after) ELSE folded END AS folded
    FROM {name}f{k} f JOIN {name}s{k} s ON s.tree = f.{'tree' if name == 'a' else 'over'} AND s.place = f.spot
)"""

    steps += [level("a", k) for k in range(8)]
    steps += ["b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, digest, tree AS lang FROM a8)"]
    steps += [level("b", k) for k in range(4)]
    steps += ["af0 AS (SELECT doc_id, tree, leaf, place AS spot, '' AS proof, altered AS folded FROM seated)"]
    steps += [fold("a", k) for k in range(8)]
    steps += [
        """bf0 AS (
    SELECT doc_id, leaf, b.digest AS subroot, '' AS over, b.place AS spot, proof, folded FROM af8 JOIN b0 b ON b.lang = af8.tree
)"""
    ]
    steps += [fold("b", k) for k in range(4)]
    return (
        ", ".join(steps)
        + """
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM bf4, b4"""
    )


#: The same result by window functions.
ORACLE = _oracle()
