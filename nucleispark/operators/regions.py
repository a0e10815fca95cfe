"""Parts, holes and contours of masks of any size, block by block.

A mask is a table of cells (slide_id, gr, gc). A task sees one block of it; what goes over block borders is joined in Spark: parts
by connected components of the runs that meet at a border, contours by doubling the pointers from each block's chains to the
next. No group is larger than a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.kernels.components import label
from nucleispark.operators.batches import begins, deal, whole_groups
from nucleispark.session import checkpointed

#: Cells on a side of a block.
BLOCK = 256
_RUN, _SIDE, _BESIDE, _PART = range(4)
_NAMES = ("what", "part", "other", "kind", "a", "b", "c", "n", "outside")
_MADE = "what int, part long, other long, kind int, a int, b int, c int, n long, outside boolean"


def connected(edges: DataFrame) -> DataFrame:
    """(slide_id, node, root) of all nodes of the edges (slide_id, a, b): root is the least node that edges lead to.

    Each round hangs larger neighbours on a node's least one and then smaller ones, until nothing changes.
    """
    key = ["slide_id", "u"]
    now = checkpointed(edges.filter("a <> b").select("slide_id", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    before = None
    while (state := now.agg(F.count("*"), F.bit_xor(F.xxhash64("slide_id", "lo", "hi"))).first()) != before:
        before = state
        both = now.select("slide_id", F.col("lo").alias("u"), F.col("hi").alias("v")).union(now.select("slide_id", "hi", "lo"))
        least = both.groupBy(*key).agg(F.min("v").alias("m")).select(*key, F.least("u", "m").alias("m"))
        up = checkpointed(both.join(least, key).filter("v > u").select("slide_id", F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = checkpointed(up.groupBy(*key).agg(F.min("v").alias("m")))
        across = up.join(least, key).filter("v <> m").select("slide_id", F.col("m").alias("lo"), F.col("v").alias("hi"))
        now = checkpointed(least.select("slide_id", F.col("m").alias("lo"), F.col("u").alias("hi")).union(across).distinct())
    return now.select("slide_id", F.col("hi").alias("node"), F.col("lo").alias("root")).union(now.select("slide_id", "lo", "lo").distinct())


def _runs(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of equal values."""
    cut = np.flatnonzero(line[1:] != line[:-1]) + 1
    return np.append(0, cut), np.append(cut, len(line)) - 1


def _block_parts(top: int, left: int, gh: int, gw: int, rows: np.ndarray, cols: np.ndarray, block: int) -> dict[str, np.ndarray]:
    """The parts of one block, numbered by their first cell's place in the whole grid: runs of their cells, runs at borders to
    other blocks, and which open background lies beside which part. Background that is closed off inside the block is filled."""
    h, w = min(block, gh - top), min(block, gw - left)
    mask = np.zeros((h, w), bool)
    mask[rows - top, cols - left] = True
    back, n = label(~mask)
    sides = [(back[0], top > 0), (back[-1], top + h < gh), (back[:, 0], left > 0), (back[:, -1], left + w < gw)]
    inner, outer = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    for line, more in sides:
        (inner if more else outer)[line] = True
    mask |= ~(inner | outer)[back] & (back > 0)
    fore, m = label(mask)
    inner[0] = False
    part = np.where(fore > 0, fore, np.where(inner[back], back + m, 0))  # 0: surely outside
    names, first, count = np.unique(part.ravel(), return_index=True, return_counts=True)
    place = np.zeros(n + m + 1, np.int64)
    place[names] = (top + first // w) * gw + left + first % w
    out = []

    def add(what: int, p: np.ndarray, **more) -> None:
        own = {"what": what, "part": place[p], "other": 0, "kind": p <= m, "a": 0, "b": 0, "c": 0, "n": 0, "outside": False} | more
        out.append([np.broadcast_to(v, len(p)) for v in own.values()])

    real = names[names > 0]
    add(_PART, real, n=count[names > 0], outside=np.append(np.zeros(m + 1, bool), outer[1:])[real])
    flat = np.pad(part, ((0, 0), (0, 1)), constant_values=-1).ravel()
    lo, hi = _runs(flat)
    keep = flat[lo] > 0
    lo, hi = lo[keep], hi[keep]
    add(_RUN, flat[lo], a=top + lo // (w + 1), b=left + lo % (w + 1), c=left + hi % (w + 1))
    for line, more, high, key, base in (
        (part[0], sides[0][1], 1, (top // block << 30 | left // block) << 1 | 1, left), (part[-1], sides[1][1], 0, (top // block + 1 << 30 | left // block) << 1 | 1, left),
        (part[:, 0], sides[2][1], 1, (left // block << 30 | top // block) << 1, top), (part[:, -1], sides[3][1], 0, (left // block + 1 << 30 | top // block) << 1, top),
    ):
        if more:
            lo, hi = _runs(line)
            add(_SIDE, line[lo], other=key, a=high, b=base + lo, c=base + hi)
    pairs = [np.stack([x.ravel(), y.ravel()], 1) for x, y in ((part[1:], part[:-1]), (part[:-1], part[1:]), (part[:, 1:], part[:, :-1]), (part[:, :-1], part[:, 1:]))]
    beside = np.concatenate(pairs)
    beside = np.unique(beside[(beside[:, 0] > 0) & (beside[:, 0] <= m) & (beside[:, 1] > m)], axis=0)
    add(_BESIDE, beside[:, 0], other=place[beside[:, 1]])
    return {name: np.concatenate(v) for name, v in zip(_NAMES, zip(*out, strict=True), strict=True)}


def _by_block(cells: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """What _block_parts finds in each block of the grids, empty blocks included."""
    step = lambda side: F.sequence(F.lit(0), F.floor((F.col(side) - 1) / block).cast("int"))
    grid = sizes.filter("gh > 0 and gw > 0").select("slide_id", "gh", "gw")
    every = grid.withColumn("br", F.explode(step("gh"))).withColumn("bc", F.explode(step("gw"))).withColumns({"gr": F.lit(-1), "gc": F.lit(-1)})
    own = cells.select("slide_id", F.col("gr").cast("int").alias("gr"), F.col("gc").cast("int").alias("gc")).join(grid, "slide_id").filter("gr between 0 and gh - 1 and gc between 0 and gw - 1")
    own = own.withColumns({"br": F.floor(F.col("gr") / block).cast("int"), "bc": F.floor(F.col("gc") / block).cast("int")})
    columns = ["slide_id", "gh", "gw", "br", "bc", "gr", "gc"]

    names = ["slide_id", "br", "bc"]

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of whole blocks, sorted."""
        starts = begins(pdf, names)
        gh, gw, br, bc, gr, gc = (pdf[c].to_numpy() for c in columns[1:])
        found = []
        for lo, hi in zip(starts, np.append(starts[1:], len(pdf)), strict=True):
            real = gr[lo:hi] >= 0
            found.append(_block_parts(int(br[lo]) * block, int(bc[lo]) * block, int(gh[lo]), int(gw[lo]), gr[lo:hi][real], gc[lo:hi][real], block))
        at = np.repeat(starts, [len(f["part"]) for f in found])
        return pd.DataFrame({"slide_id": pdf["slide_id"].to_numpy()[at], **{n: np.concatenate([f[n] for f in found]) for n in _NAMES}})

    kind = cells.schema["slide_id"].dataType.simpleString()
    dealt = deal(every.select(*columns).unionByName(own.select(*columns)), *names).sortWithinPartitions(*names)
    return dealt.mapInPandas(whole_groups(names, some), f"slide_id {kind}, {_MADE}")


def filled_runs(cells: DataFrame, sizes: DataFrame, least_share: float = 0.0, block: int = BLOCK) -> DataFrame:
    """(slide_id, gr, c0, c1, component): runs of cells, the last column in it, of the masks with holes filled; component numbers the
    4-connected parts by their first cell in row-major order, after those below a share of the grid are gone.

    A hole is background that no chain of 4-neighbours leads out of the grid. Cells outside of their grid (slide_id, gh, gw) and slides
    without one are left out; repeated cells count once.
    """
    made = checkpointed(_by_block(cells, sizes, block))
    parts = made.filter(F.col("what") == _PART).select("slide_id", "part", "kind", "n", "outside")
    side = made.filter(F.col("what") == _SIDE)
    end = lambda high, name: side.filter(F.col("a") == high).select("slide_id", "other", F.col("part").alias(name), F.col("kind").alias(f"k{name}"), F.col("b").alias(f"b{name}"), F.col("c").alias(f"c{name}"))
    meets = end(0, "x").join(end(1, "y"), ["slide_id", "other"]).filter("bx <= cy and by <= cx").select("slide_id", "x", "y", "kx", "ky")
    named = parts.select("slide_id", F.col("part").alias("node"))
    own = named.withColumn("root", F.col("node"))
    rooted = lambda edges: own.join(connected(edges).withColumnRenamed("root", "_r"), ["slide_id", "node"], "left").select("slide_id", "node", F.coalesce("_r", "root").alias("root"))
    if parts.filter("kind = 0").isEmpty() and meets.isEmpty():  # all was decided inside of blocks
        filled, roots = parts, own
    else:
        meets = checkpointed(meets)
        back = parts.filter("kind = 0")
        lanes = checkpointed(rooted(meets.filter("kx = 0 and ky = 0").select("slide_id", F.col("x").alias("a"), F.col("y").alias("b"))).join(back.select("slide_id", F.col("part").alias("node"), "outside"), ["slide_id", "node"]))
        ways_out = lanes.groupBy("slide_id", "root").agg(F.bool_or("outside").alias("out"))
        holes = checkpointed(lanes.drop("outside").join(ways_out.filter("not out"), ["slide_id", "root"]).select("slide_id", F.col("node").alias("part")))
        filled = parts.filter("kind = 1").join(holes, ["slide_id", "part"], "left").unionByName(back.join(holes, ["slide_id", "part"]))
        beside = made.filter(F.col("what") == _BESIDE).select("slide_id", F.col("part").alias("x"), F.col("other").alias("y"), F.lit(1).alias("kx"), F.lit(0).alias("ky"))
        edges = meets.unionByName(beside)
        ok = lambda e, c: e.join(holes.withColumnRenamed("part", c), ["slide_id", c], "left_semi").unionByName(e.filter(F.col(f"k{c}") == 1))
        good = ok(ok(edges.select("slide_id", "x", "y", "kx", "ky"), "x").select("slide_id", "x", "y", "kx", "ky"), "y")
        roots = rooted(good.select("slide_id", F.col("x").alias("a"), F.col("y").alias("b")))
    found = filled.join(roots.withColumnRenamed("node", "part"), ["slide_id", "part"]).select("slide_id", "part", "root", "n")
    whole = found.groupBy("slide_id", "root").agg(F.sum("n").alias("n")).join(sizes.select("slide_id", "gh", "gw"), "slide_id")
    kept = whole.filter(F.col("n") >= F.lit(least_share) * F.col("gh") * F.col("gw"))
    numbered = kept.select("slide_id", "root", F.row_number().over(Window.partitionBy("slide_id").orderBy("root")).alias("component"))
    of_part = found.join(numbered, ["slide_id", "root"]).select("slide_id", "part", "component")
    runs = made.filter(F.col("what") == _RUN).select("slide_id", "part", F.col("a").alias("gr"), F.col("b").alias("c0"), F.col("c").alias("c1"))
    return runs.join(of_part, ["slide_id", "part"]).select("slide_id", "gr", "c0", "c1", "component")


def run_cells(runs: DataFrame) -> DataFrame:
    """(slide_id, gr, gc, component), one row a cell."""
    return runs.select("slide_id", "gr", F.explode(F.sequence("c0", "c1")).alias("gc"), "component")


# Marching squares: for each code of a 2 x 2 quad (1 upper left, 2 upper right, 4 lower left, 8 lower right) the sides that its contour
# pieces join, with the set cells on the same hand. Diagonal set cells are apart.
_PIECES = {
    1: ["LT"], 2: ["TR"], 3: ["LR"], 8: ["RB"], 9: ["LT", "RB"], 10: ["TB"], 11: ["LB"], 4: ["BL"], 5: ["BT"], 6: ["TR", "BL"], 7: ["BR"], 12: ["RL"], 13: ["RT"], 14: ["TL"],
}
_SIDES = {"T": (0, 1), "R": (1, 2), "B": (2, 1), "L": (1, 0)}


def half_edges(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """(slide_id, gh, gw, qr, qc, from, to): the directed contour pieces at level 0.5 of the masks, by the quad they lie in; ends are numbers
    of points in half cells, (2 y + 2) * (2 gw + 5) + 2 x + 2."""
    corners = F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(1 << (2 * dr + dc)).alias("bit")) for dr in (0, 1) for dc in (0, 1)))
    own = cells.select("slide_id", "gr", "gc").distinct().join(sizes.select("slide_id", "gh", "gw"), "slide_id").filter("gr between 0 and gh - 1 and gc between 0 and gw - 1")
    near = own.select("slide_id", "gh", "gw", "gr", "gc", F.inline(corners)).select("slide_id", "gh", "gw", (F.col("gr") - F.col("dr")).alias("qr"), (F.col("gc") - F.col("dc")).alias("qc"), "bit")
    quads = near.groupBy("slide_id", "gh", "gw", "qr", "qc").agg(F.sum("bit").cast("int").alias("code")).filter("code < 15")
    piece = lambda p: F.struct(*(F.lit(x).alias(n) for n, x in zip(("sy", "sx", "ey", "ex"), (*_SIDES[p[0]], *_SIDES[p[1]]), strict=True)))
    table = F.array(*(F.array(*(piece(p) for p in _PIECES.get(code, ["LT"]))) for code in range(15)))
    both = quads.select("slide_id", "gh", "gw", "qr", "qc", F.inline(F.get(table, F.col("code"))))
    point = lambda y, x: ((2 * F.col("qr") + F.col(y) + 2).cast("long") * (2 * F.col("gw") + 5) + 2 * F.col("qc") + F.col(x) + 2).cast("long")
    return both.select("slide_id", "gh", "gw", "qr", "qc", point("sy", "sx").alias("from"), point("ey", "ex").alias("to"))


def _chains(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int, int]]]:
    """Each piece's chain (its head point) and place in it; and chains: head, what comes after, length, least point and its place.
    A chain whose next is its head is a ring."""
    after = dict(zip(start.tolist(), end.tolist(), strict=True))
    at = {p: i for i, p in enumerate(start.tolist())}
    chain, place = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    found = []
    open_heads = sorted(after.keys() - set(after.values()))
    left = dict.fromkeys(sorted(after))
    for head in (*open_heads, *list(left)):
        if head not in left:
            continue
        p, n, low, low_at = head, 0, head, 0
        while p in left:
            del left[p]
            chain[at[p]], place[at[p]] = head, n
            if p < low:
                low, low_at = p, n
            p, n = after[p], n + 1
        found.append((head, p, n, low, low_at))
    return chain, place, found


def contour_points(cells: DataFrame, sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slide_id, ring, k, y, x, twice_area): vertices of the contours at 0.5, cut to the centres of the border cells, in order; ring
    is the number of the ring's least point, where it begins. twice_area: the vertex's own term with the next one, which sum to twice
    the area, with a sign."""
    pieces = half_edges(cells, sizes).withColumns({"br": F.floor(F.col("qr") / block).cast("int"), "bc": F.floor(F.col("qc") / block).cast("int")})

    names, columns = ["slide_id", "br", "bc"], ["chain", "place", "from", "to", "low", "low_at", "head"]

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of whole blocks, sorted."""
        starts = begins(pdf, names)
        start, end = pdf["from"].to_numpy(), pdf["to"].to_numpy()
        parts, whose = [], []
        for lo, hi in zip(starts, np.append(starts[1:], len(pdf)), strict=True):
            chain, place, found = _chains(start[lo:hi], end[lo:hi])
            head, after, n, low, low_at = np.array(found, np.int64).T
            parts += [(chain, place, start[lo:hi], end[lo:hi], chain * 0, chain * 0, chain < 0), (head, n, head * 0, after, low, low_at, head >= 0)]
            whose += [(lo, hi - lo), (lo, len(head))]
        at = np.repeat(*np.array(whose).T)
        return pd.DataFrame({"slide_id": pdf["slide_id"].to_numpy()[at], **{c: np.concatenate(v) for c, v in zip(columns, zip(*parts, strict=True), strict=True)}})

    kind = cells.schema["slide_id"].dataType.simpleString()
    dealt = deal(pieces.select(*names, "from", "to"), *names).sortWithinPartitions(*names)
    made = checkpointed(dealt.mapInPandas(whole_groups(names, some), f"slide_id {kind}, chain long, place long, from long, to long, low long, low_at long, head boolean"))
    chains = made.filter("head").select("slide_id", "chain", F.col("to").alias("next"), F.col("place").alias("n"), "low", "low_at")
    rings = _ranked(chains)
    own = made.filter("not head").select("slide_id", "chain", "place", "from", "to").join(rings, ["slide_id", "chain"]).join(sizes.select("slide_id", "gh", "gw"), "slide_id")
    wide = 2 * F.col("gw") + 5
    at = lambda c, side: F.greatest(F.lit(0.0), F.least((F.floor(F.col(c) / wide) - 2 if side == "gh" else F.col(c) % wide - 2) / 2.0, F.col(side) - 1.0))
    own = own.select("slide_id", "ring", F.pmod(F.col("offset") + F.col("place"), F.col("total")).alias("k"), at("from", "gh").alias("y"), at("from", "gw").alias("x"), at("to", "gh").alias("y2"), at("to", "gw").alias("x2"))
    return own.select("slide_id", "ring", "k", "y", "x", (F.col("x") * F.col("y2") - F.col("x2") * F.col("y")).alias("twice_area"))


def _ranked(chains: DataFrame) -> DataFrame:
    """(slide_id, chain, ring, offset, total): each chain's ring, the place of its head from the ring's least point on (below 0 if that
    comes later), and how many points the ring has. Pointers are doubled until a ring's least point is known to all its chains,
    and again to add up the lengths up to it: rounds go with the logarithm of the chains in a ring."""
    closed = chains.filter("next = chain").select("slide_id", "chain", F.col("low").alias("ring"), (-F.col("low_at")).alias("offset"), F.col("n").alias("total"))
    open_ones = checkpointed(chains.filter("next <> chain"))
    if open_ones.isEmpty():
        return closed
    key = ["slide_id", "chain"]
    least = lambda rows: rows.agg(F.bit_xor(F.xxhash64("slide_id", "chain", "ring"))).first()[0]
    now, was = open_ones.select(*key, "next", F.col("low").alias("ring")), None
    while (state := least(now)) != was:
        was = state
        ahead = now.select("slide_id", F.col("chain").alias("next"), F.col("next").alias("far"), F.col("ring").alias("r"))
        now = checkpointed(now.join(ahead, ["slide_id", "next"]).select(*key, F.col("far").alias("next"), F.least("ring", "r").alias("ring")))
    rings = checkpointed(open_ones.join(now.select(*key, "ring"), key))
    first = rings.filter("low = ring").select("slide_id", "ring", F.col("chain").alias("begin"))
    # Points from a chain's head to the head of the ring's first chain; from there a pointer leads nowhere.
    cut = rings.join(first, ["slide_id", "ring"]).select(*key, "ring", "n", "low_at", "begin", F.when(F.col("next") != F.col("begin"), F.col("next")).alias("next"), F.col("n").alias("rest"))
    cut = checkpointed(cut)
    while not cut.filter("next is not null").isEmpty():
        ahead = cut.select("slide_id", F.col("chain").alias("next"), F.col("next").alias("far"), F.col("rest").alias("more"))
        cut = checkpointed(cut.join(ahead, ["slide_id", "next"], "left").select(*key, "ring", "n", "low_at", "begin", F.col("far").alias("next"), (F.col("rest") + F.coalesce("more", F.lit(0))).alias("rest")))
    whole = cut.filter("chain = begin").select("slide_id", "ring", F.col("rest").alias("total"), F.col("low_at").alias("begin_at"))
    return closed.unionByName(cut.join(whole, ["slide_id", "ring"]).select(*key, "ring", (F.col("total") - F.col("rest") - F.col("begin_at")).alias("offset"), "total"))


def contours(cells: DataFrame, sizes: DataFrame, divisor: float = 1, least_share: float = 0.0, block: int = BLOCK) -> DataFrame:
    """(slide_id, ring, vertices, area): closed contours times the divisor, numbered from 0 on by their first point, without those
    below a share of a slide's whole area. A ring is one value, so it must fit a row; contour_points gives it as rows."""
    points = checkpointed(contour_points(cells, sizes, block))
    areas = points.groupBy("slide_id", "ring").agg((F.abs(F.sum("twice_area")) / 2 * divisor**2).alias("area"))
    share = F.col("area") / F.nullif(F.sum("area").over(Window.partitionBy("slide_id")), F.lit(0.0))
    kept = areas.withColumn("_s", share).filter(F.col("_s") >= least_share).drop("_s") if least_share else areas
    kept = kept.withColumn("_n", (F.row_number().over(Window.partitionBy("slide_id").orderBy("ring")) - 1).cast("int"))
    vertex: Column = F.struct("k", (F.col("x") * divisor).alias("x"), (F.col("y") * divisor).alias("y"))
    listed = points.join(kept, ["slide_id", "ring"]).groupBy("slide_id", "_n", "area").agg(F.array_sort(F.collect_list(vertex)).alias("v"))
    vertices = F.transform(F.concat("v", F.slice("v", 1, 1)), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return listed.select("slide_id", F.col("_n").alias("ring"), vertices.alias("vertices"), "area")
