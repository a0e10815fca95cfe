"""Merkle manifest of a dataset: leaves, subtree roots, one root and a proof for each row.

A row is a leaf; the leaves of one source, in the order of their keys, make a tree whose runs of FAN nodes become one; the
subtree roots, by source, make the tree above in the same way. Places in a tree come from one range partitioning and the
counts before each partition, so no source is in one task. The tree is cut into superblocks of FAN ** DEPTH places: a
first pass reduces each to its top node, the tops are the nodes of the next, far smaller tier, and so on until a tier has
one superblock a tree. On the way down the nodes of each superblock are cogrouped with the outer nodes that its proofs need,
which are the same for all of them, and local reduction, proofs and folding are finished together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nucleispark.session import checkpointed

#: Children of a node, and levels of a superblock (3 ** 7 = 2187 places).
FAN, DEPTH = 3, 7
_OUTER = "before array<string>, after array<string>, top string, root string"


def encoded(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(encoded(c) for c in columns)), 256)


def _ranged(rows: DataFrame, tree: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows in ranges of (tree, order), nulls first, and for each tree and range of it (_t, _p, _n rows, _shift from a row's _at
    to its place in the tree). A tree lies over as many ranges as it needs."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Repeated rows are alike, so the last key may part them in any way.
    ranged = checkpointed(rows.withColumn("_from", F.spark_partition_id()).repartitionByRange(n, tree, *order, "_from").sortWithinPartitions(tree, *order).drop("_from"))
    numbered = ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    counts = numbered.groupBy(F.col(tree).alias("_t"), F.col("_part").alias("_p")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.expr("sum(_n) OVER (PARTITION BY _t ORDER BY _p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _n")
    return numbered, checkpointed(counts.select("_t", "_p", "_n", (before - F.col("_first")).alias("_shift")))


def _placed(numbered: DataFrame, shifts: DataFrame, tree: str) -> DataFrame:
    """The rows with pos, their place in the tree from 0 on, and the other columns of shifts."""
    joined = numbered.join(shifts, (numbered["_part"] == shifts["_p"]) & numbered[tree].eqNullSafe(shifts["_t"]))
    return joined.withColumn("pos", (F.col("_at") + F.col("_shift")).cast("long")).drop("_part", "_at", "_t", "_p", "_n", "_shift")


def _levels(n: int, depth: int) -> int:
    """Levels that a superblock of a tree of n nodes reduces: depth, or fewer if the tree is reduced to one node before."""
    k = 0
    while n > 1 and k < depth:
        n, k = -(-n // FAN), k + 1
    return k


def _reduce(hashes: list[str], k: int) -> list[list[str]]:
    """The hashes and those of the next k levels, runs of FAN becoming one."""
    levels = [hashes]
    for _ in range(k):
        h = levels[-1]
        levels.append([hashlib.sha256("".join(h[i : i + FAN]).encode()).hexdigest() for i in range(0, len(h), FAN)])
    return levels


def _blocks(pdf: pd.DataFrame, span: int) -> list[tuple[int, int]]:
    """Ranges of rows of each superblock, of rows sorted by tree and place."""
    if not len(pdf):
        return []
    t, b = pdf["tree"].to_numpy(), pdf["pos"].to_numpy() // span
    cut = np.flatnonzero((t[1:] != t[:-1]) | (b[1:] != b[:-1])) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(pdf)], strict=True))


def _grouped(rows: DataFrame, place: Column, groups: int) -> DataFrame:
    """Adds _g: superblocks (tree, place div span) dealt to so many groups, so that small trees share one."""
    return rows.withColumn("_g", F.pmod(F.xxhash64("tree", place), F.lit(groups)))


def _tops(nodes: DataFrame, groups: int, depth: int) -> DataFrame:
    """(tree, pos, n, h): the next tier, superblocks reduced to their top nodes."""
    span = FAN**depth

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tree", "pos"], ignore_index=True)
        out = []
        for a, b in _blocks(pdf, span):
            n = int(pdf["n"].iat[a])
            top = _reduce(pdf["h"].iloc[a:b].tolist(), _levels(n, depth))[-1]
            out.append((pdf["tree"].iat[a], pdf["pos"].iat[a] // span, -(-n // span), top[0]))
        return pd.DataFrame(out, columns=["tree", "pos", "n", "h"])

    own = nodes.select("tree", "pos", "n", "h")
    return _grouped(own, F.floor(F.col("pos") / span), groups).groupBy("_g").applyInPandas(one, "tree long, pos long, n long, h string")


def _siblings(levels: list[list[str]], i: int, k: int) -> tuple[list[str], list[str]]:
    """At each of k levels what stands before and after the node above place i in its run."""
    before, after = [], []
    for h in levels[:k]:
        lo = i - i % FAN
        before.append("".join(h[lo:i]))
        after.append("".join(h[i + 1 : lo + FAN]))
        i //= FAN
    return before, after


def _outer_of_nodes(nodes: DataFrame, above: DataFrame, groups: int, depth: int) -> DataFrame:
    """(tree, pos, before, after, top, root) of each node of a tier, from those of the tier above."""
    span = FAN**depth

    def one(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["tree", "pos"], ignore_index=True)
        up = {(t, p): rest for t, p, *rest in outer[["tree", "pos", "before", "after", "top", "root"]].itertuples(index=False)}
        out = []
        for a, b in _blocks(own, span):
            k = _levels(int(own["n"].iat[a]), depth)
            levels = _reduce(own["h"].iloc[a:b].tolist(), k)
            t, base = own["tree"].iat[a], own["pos"].iat[a]
            far_before, far_after, top, root = up[t, base // span]
            for i in range(b - a):
                before, after = _siblings(levels, i, k)
                out.append((t, base + i, [*before, *far_before], [*after, *far_after], top, root))
        return pd.DataFrame(out, columns=["tree", "pos", "before", "after", "top", "root"])

    left = _grouped(nodes.select("tree", "pos", "n", "h"), F.floor(F.col("pos") / span), groups).groupBy("_g")
    return left.cogroup(_grouped(above, F.col("pos"), groups).groupBy("_g")).applyInPandas(one, f"tree long, pos long, {_OUTER}")


def _up(nodes: DataFrame, depth: int) -> tuple[list[DataFrame], list[int]]:
    """The tiers of trees of nodes (tree, pos, n, h), up to one node a tree, and how many groups the superblocks of each are dealt to."""
    span = FAN**depth
    tiers, groups = [nodes], []
    while True:
        rows, most = tiers[-1].agg(F.count("*"), F.max("n")).first()
        groups.append(max(1, -(-rows // span)))
        if len(tiers) > 1 and (most or 0) <= 1:
            return tiers, groups
        tiers.append(checkpointed(_tops(tiers[-1], groups[-1], depth)))


def _down(tiers: list[DataFrame], groups: list[int], above: DataFrame, depth: int) -> DataFrame:
    """From the outer nodes of the trees' tops those of the lowest tier's superblocks."""
    for tier, g in list(zip(tiers, groups, strict=True))[-2:0:-1]:
        above = checkpointed(_outer_of_nodes(tier, above, g, depth))
    return above


def _finish(nodes: DataFrame, above: DataFrame, groups: int, depth: int) -> DataFrame:
    """Leaves cogrouped with their superblocks' outer nodes: reduced, proven and folded."""
    span = FAN**depth

    def one(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["tree", "pos"], ignore_index=True)
        up = {(t, p): rest for t, p, *rest in outer[["tree", "pos", "before", "after", "top", "root"]].itertuples(index=False)}
        out = []
        for a, b in _blocks(own, span):
            k = _levels(int(own["n"].iat[a]), depth)
            hashes = own["h"].iloc[a:b].tolist()
            levels = _reduce(hashes, k)
            far_before, far_after, top, root = up[own["tree"].iat[a], own["pos"].iat[a] // span]
            for i, (key, h, new) in enumerate(zip(own["id"].iloc[a:b], hashes, own["changed"].iloc[a:b], strict=True)):
                before, after = _siblings(levels, i, k)
                pairs = [*zip(before, after, strict=True), *zip(far_before, far_after, strict=True)]
                proof = hashlib.sha256("".join(x + y for x, y in pairs).encode()).hexdigest()
                folded = h if new is None else new
                for x, y in pairs:
                    folded = hashlib.sha256((x + folded + y).encode()).hexdigest()
                out.append((key, h, top, root, proof, folded, folded == root))
        return pd.DataFrame(out, columns=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"], dtype=object)

    kind = nodes.schema["id"].dataType.simpleString()
    left = _grouped(nodes, F.floor(F.col("pos") / span), groups).groupBy("_g")
    return left.cogroup(_grouped(above, F.col("pos"), groups).groupBy("_g")).applyInPandas(one, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest(rows: DataFrame, columns: Sequence[str], *, id: str, tree: str, tampered: Sequence[Column] | None = None, when: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """One row per row: id, leaf, subroot (of its tree's leaves), root, proof_sha256 (of all siblings on the way, in order),
    folded_root (from the tampered columns' leaf where `when` holds, else its own, and the siblings) and verified (equals root).

    Leaves of a tree go by id, nulls first, then by their hash; trees go by their value, null first. Null values have a mark of
    their own and differ from empty ones. Equal rows are leaves of their own, and alike but for their place. Texts are hashed
    where they are read; only hashes are shuffled. An empty table gives no rows; other columns are not looked at. depth: levels of a
    superblock; the result is the same for all.
    """
    changed = F.lit(None).cast("string") if when is None or tampered is None else F.when(when, leaf_hash(tampered))
    leaves = checkpointed(rows.select(F.col(f"`{id}`").alias("id"), F.col(f"`{tree}`").alias("source"), leaf_hash([F.col(f"`{c}`") for c in columns]).alias("h"), changed.alias("changed")))
    numbered, shifts = _ranged(leaves, "source", ["id", "h"])
    sizes, places = _ranged(shifts.groupBy(F.col("_t").alias("source")).agg(F.sum("_n").alias("n")).withColumn("all", F.lit(0)), "all", ["source"])
    trees = _placed(sizes, places, "all").select(F.col("source").alias("_source"), F.col("pos").alias("tree"), "n")
    nodes = checkpointed(_placed(numbered, shifts.join(trees, shifts["_t"].eqNullSafe(trees["_source"])).drop("_source"), "source").select("id", "tree", "pos", "n", "h", "changed"))
    tiers, groups = _up(nodes, depth)
    # The trees' tops are the leaves of the tree above.
    subroots = tiers[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(tiers[-1].count()).cast("long").alias("n"), "h")
    upper, upper_groups = _up(subroots, depth)
    none = F.array().cast("array<string>")
    last = upper[-1].select("tree", "pos", none.alias("before"), none.alias("after"), F.col("h").alias("top"), F.col("h").alias("root"))
    far = _outer_of_nodes(subroots, _down(upper, upper_groups, last, depth), upper_groups[0], depth).select(F.col("pos").alias("tree"), "before", "after", "root")
    tops = tiers[-1].select("tree", "pos", F.col("h").alias("top")).join(far, "tree").select("tree", "pos", "before", "after", "top", "root")
    return _finish(nodes, _down(tiers, groups, checkpointed(tops), depth), groups[0], depth).withColumnRenamed("id", id)
