"""Regions of interest: cells, hole filling, components, area, polygons, random points and patches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nucleispark.functions.scalars import polygon_area
from nucleispark.kernels import ears
from nucleispark.operators import regions
from nucleispark.session import checkpointed


def roi_cells(density: DataFrame, classes: tuple[int, ...] = (0,)) -> DataFrame:
    """(slide_id, gr, gc): cells where a class of the region has a positive density."""
    return density.filter(F.col("cls").isin(*classes) & (F.col("d") > 0)).select("slide_id", "gr", "gc").distinct()


def fill_and_label(cells: DataFrame, sizes: DataFrame, least_share: float = 0.0, block: int = regions.BLOCK) -> DataFrame:
    """(slide_id, gr, gc, component): cells with holes filled, numbered by 4-connected part; parts below a share of the grid go.
    Worked out by blocks of block * block cells, whatever the slide's size."""
    return regions.run_cells(regions.filled_runs(cells, sizes, least_share, block))


def quad_codes(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """(slide_id, qr, qc, code): the 2 x 2 quads of cells inside the grid, upper left cell at (qr, qc); code has bit 1 for the upper left,
    2 upper right, 4 lower left, 8 lower right cell."""
    corners = F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(1 << (2 * dr + dc)).alias("bit")) for dr in (0, 1) for dc in (0, 1)))
    near = cells.select("slide_id", "gr", "gc", F.inline(corners)).select("slide_id", (F.col("gr") - F.col("dr")).alias("qr"), (F.col("gc") - F.col("dc")).alias("qc"), "bit")
    inside = near.join(sizes, "slide_id").filter("qr >= 0 and qc >= 0 and qr < gh - 1 and qc < gw - 1")
    return inside.groupBy("slide_id", "qr", "qc").agg(F.sum("bit").cast("int").alias("code"))


def roi_area(cells: DataFrame, sizes: DataFrame, divisor: int) -> DataFrame:
    """(slide_id, roi_area) of masks without holes, in slide pixels: what the contours at 0.5 enclose, cut to the centres of the border cells.

    By quads: one set cell is 1/8, two side by side 1/2, two across 1/4, three 7/8, four 1.
    """
    n = F.bit_count("code")
    across = F.col("code").isin(6, 9)
    share = F.when(n == 1, 0.125).when((n == 2) & across, 0.25).when(n == 2, 0.5).when(n == 3, 0.875).otherwise(1.0)
    return quad_codes(cells, sizes).groupBy("slide_id").agg((F.sum(share) * divisor**2).alias("roi_area"))


def roi_polygons(cells: DataFrame, sizes: DataFrame, divisor: int, least_share: float = 0.05, block: int = regions.BLOCK) -> DataFrame:
    """(slide_id, ring, vertices, area): contours in slide pixels, without those below a share of all area; traced by blocks."""
    return regions.contours(cells, sizes, divisor, least_share, block)


def in_polygon(x: Column, y: Column, vertices: Column) -> Column:
    """Even-odd test by the parity of crossings to the right."""
    after = F.concat(F.slice(vertices, 2, F.greatest(F.size(vertices) - 1, F.lit(0))), F.slice(vertices, 1, 1))
    crosses = F.zip_with(vertices, after, lambda a, b: ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]))
    return F.coalesce(F.aggregate(crosses, F.lit(0), lambda n, c: n + F.coalesce(c, F.lit(False)).cast("int")) % 2 == 1, F.lit(False))


def polygon_edges(polygons: DataFrame, bin_size: int, keys: tuple[str, ...] = ("slide_id", "poly_id")) -> DataFrame:
    """(keys, _bx, _by, edges): for each grid bin of a polygon's box the edges that a ray to the right from the bin can cross: those of the
    bin's band of rows that don't end left of it. Polygons that share their keys are the rings of one shape."""
    corner = F.col("vertices")
    after = F.concat(F.slice(corner, 2, F.greatest(F.size(corner) - 1, F.lit(0))), F.slice(corner, 1, 1))
    left = F.floor(F.array_min(F.transform(corner, lambda p: p["x"])) / bin_size)
    pair = F.zip_with(corner, after, lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    edges = polygons.filter(F.size(corner) > 2).select(*keys, left.alias("_left"), F.inline(pair)).filter("ay <> by")
    at = lambda f, a, b: F.floor(f(a, b) / bin_size)
    listed = edges.withColumn("_by", F.explode(F.sequence(at(F.least, "ay", "by"), at(F.greatest, "ay", "by")))).withColumn("_bx", F.explode(F.sequence("_left", at(F.greatest, "ax", "bx"))))
    return listed.groupBy(*keys, "_bx", "_by").agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("_edges"))


def odd_crossings(x: Column, y: Column, edges: Column) -> Column:
    """Whether a ray to the right crosses an odd number of edges, as polygon_edges lists them."""
    crosses = lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])
    return F.aggregate(edges, F.lit(0), lambda n, e: n + crosses(e).cast("int")) % 2 == 1


def points_in_polygons(points: DataFrame, polygons: DataFrame, bin_size: int) -> DataFrame:
    """Points (slide_id, x, y) with the poly_id of each polygon (slide_id, poly_id, vertices) that holds them by the even-odd rule.

    A point meets the edges listed under its own grid bin only, not whole polygons: those of its band of bin_size rows, to
    its right. Rings that share a poly_id are one shape. Null and empty polygons hold nothing; repeated points stay.
    """
    near = points.withColumns({"_bx": F.floor(F.col("x") / bin_size), "_by": F.floor(F.col("y") / bin_size)}).join(polygon_edges(polygons, bin_size), ["slide_id", "_bx", "_by"])
    return near.filter(odd_crossings(F.col("x"), F.col("y"), F.col("_edges"))).select(*points.columns, "poly_id")


def cells_of_polygons(polygons: DataFrame, divisor: int) -> DataFrame:
    """(slide_id, gr, gc): pooled cells whose centres lie in a polygon (slide_id, poly_id, vertices)."""
    side = lambda f, c: f(F.transform("vertices", lambda p: p[c]))
    span = lambda c: F.sequence(F.floor(side(F.array_min, c) / divisor).cast("int"), F.floor(side(F.array_max, c) / divisor).cast("int"))
    at = polygons.filter("size(vertices) > 2").select("slide_id", "vertices", span("x").alias("gc"), F.explode(span("y")).alias("gr")).withColumn("gc", F.explode("gc"))
    centre = lambda c: (F.col(c) + 0.5) * divisor
    return at.filter(in_polygon(centre("gc"), centre("gr"), F.col("vertices"))).select("slide_id", "gr", "gc").distinct()


def flip_polygons(polygons: DataFrame, how: str, w: str = "w", h: str = "h") -> DataFrame:
    """Vertices mirrored in x or y within the size, or with axes swapped (`t`)."""
    new = {"x": lambda p: F.struct((F.col(w) - p["x"]).alias("x"), p["y"].alias("y")), "y": lambda p: F.struct(p["x"].alias("x"), (F.col(h) - p["y"]).alias("y")), "t": lambda p: F.struct(p["y"].alias("x"), p["x"].alias("y"))}[how]
    return polygons.withColumn("vertices", F.transform("vertices", new))


def scale_polygons(slides: DataFrame, polygons: DataFrame, factor: float) -> DataFrame:
    """(slide_id, poly_id, vertices, area) times factor and cut to the scaled slide; slides without polygon get their whole rectangle as poly_id 0."""
    cut = lambda v, side: F.greatest(F.lit(0.0), F.least(v * factor, (F.col(side) * factor).cast("double")))
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    whole = F.array(corner(F.lit(0), F.lit(0)), corner(F.col("w"), F.lit(0)), corner(F.col("w"), F.col("h")), corner(F.lit(0), F.col("h")))
    joined = slides.select("slide_id", "h", "w").join(polygons.select("slide_id", "poly_id", "vertices"), "slide_id", "left")
    vertices = F.transform(F.coalesce("vertices", whole), lambda p: F.struct(cut(p["x"], "w").alias("x"), cut(p["y"], "h").alias("y")))
    out = joined.select("slide_id", F.coalesce("poly_id", F.lit(0)).alias("poly_id"), vertices.alias("vertices"))
    return out.withColumn("area", polygon_area(F.col("vertices")))


def _draws(size: DataFrame, n: int, seed: int) -> DataFrame:
    """(slide_id, m, k, rank): n hashed places, from 0 on, among the m of each slide."""
    return size.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("rank", F.floor(_uniform(seed, "cell") * F.col("m")).cast("int"))


def _uniform(seed: int, salt: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "slide_id", "k", F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def sample_in_cells(cells: DataFrame, n: int, cell: int, seed: int = 42) -> DataFrame:
    """(slide_id, k, x, y): n points of each slide, evenly spread over its region's cells; the same for the same seed.

    Point k takes the cell of the rank that its hash picks, and a place in it from two more hashes.
    """
    from pyspark.sql import Window

    ranked = cells.withColumn("rank", F.row_number().over(Window.partitionBy("slide_id").orderBy("gr", "gc")) - 1)
    at = _draws(cells.groupBy("slide_id").agg(F.count("*").alias("m")), n, seed).join(ranked, ["slide_id", "rank"])
    return at.select("slide_id", "k", ((F.col("gc") + _uniform(seed, "x")) * cell).alias("x"), ((F.col("gr") + _uniform(seed, "y")) * cell).alias("y"))


def sample_in_runs(runs: DataFrame, n: int, cell: int, seed: int = 42) -> DataFrame:
    """sample_in_cells of the cells of disjoint runs (slide_id, gr, c0, c1), the last column in it, without a row for each cell.

    The runs of a slide are laid end to end, and both sides of the range join are listed by n equal parts of the whole.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("slide_id").orderBy("gr", "c0")
    length = F.col("c1") - F.col("c0") + 1
    upto = F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = runs.select("slide_id", "gr", "c0", "c1", upto.alias("_to"), F.sum(length).over(Window.partitionBy("slide_id")).alias("_m")).withColumn("_from", F.col("_to") - length)
    part = lambda place, m: F.floor(place * n / m).cast("int")
    parts = laid.withColumn("_part", F.explode(F.sequence(part(F.col("_from"), F.col("_m")), part(F.col("_to") - 1, F.col("_m")))))
    draws = _draws(runs.groupBy("slide_id").agg(F.sum(length).alias("m")), n, seed).withColumn("_part", part(F.col("rank"), F.col("m")))
    at = draws.join(parts, ["slide_id", "_part"]).filter("rank >= _from and rank < _to").withColumn("gc", F.col("c0") + F.col("rank") - F.col("_from"))
    return at.select("slide_id", "k", ((F.col("gc") + _uniform(seed, "x")) * cell).alias("x"), ((F.col("gr") + _uniform(seed, "y")) * cell).alias("y"))


def polygon_triangles(polygons: DataFrame) -> DataFrame:
    """(slide_id, poly_id, tri, ax, ay, bx, by, cx, cy, area): the triangles of simple polygons (slide_id, poly_id, vertices), from 0 on."""
    kinds = {c: polygons.schema[c].dataType.simpleString() for c in ("slide_id", "poly_id")}
    names = ["ax", "ay", "bx", "by", "cx", "cy"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for slide, poly, v in pdf.itertuples(index=False):
                t = ears.triangles(np.array([(q["x"], q["y"]) for q in v], float)).reshape(-1, 6)
                own = pd.DataFrame(t, columns=names)
                own.insert(0, "tri", np.arange(len(t)))
                own.insert(0, "poly_id", poly)
                own.insert(0, "slide_id", slide)
                yield own

    found = polygons.filter("size(vertices) > 2").select("slide_id", "poly_id", "vertices").mapInPandas(run, f"slide_id {kinds['slide_id']}, poly_id {kinds['poly_id']}, tri int, " + ", ".join(f"{n} double" for n in names))
    return found.withColumn("area", F.abs((F.col("bx") - F.col("ax")) * (F.col("cy") - F.col("ay")) - (F.col("by") - F.col("ay")) * (F.col("cx") - F.col("ax"))) / 2)


def sample_in_polygons(polygons: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """(slide_id, k, x, y, poly_id): n points of each slide, evenly spread over the area of its simple polygons; the same for the same seed.

    Point k's hash picks a place in the slide's triangles laid end to end by area, and two more hashes a place in that triangle. Both
    sides of this range join are listed by equal parts of the whole area, as many as there are points. Where polygons overlap, their
    common area counts for each. Slides whose polygons have no area get no points.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("slide_id").orderBy("poly_id", "tri")
    laid = polygon_triangles(polygons).filter("area > 0").withColumn("_to", F.sum("area").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    laid = laid.withColumns({"_from": F.coalesce(F.lag("_to").over(order), F.lit(0.0)), "_all": F.max("_to").over(Window.partitionBy("slide_id"))})
    laid = checkpointed(laid)
    share = lambda place: F.least(F.lit(n - 1), F.floor(place / F.col("_all") * n).cast("int"))
    parts = laid.withColumn("_part", F.explode(F.sequence(share(F.col("_from")), share(F.col("_to")))))
    uniform = lambda salt: F.pmod(F.xxhash64(F.lit(seed), "slide_id", "k", F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    draws = laid.select("slide_id", "_all").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("_at", uniform("area") * F.col("_all"))
    at = draws.withColumn("_part", share(F.col("_at"))).drop("_all").join(parts, ["slide_id", "_part"]).filter("_at >= _from and _at < _to")
    root, v = F.sqrt(uniform("x")), uniform("y")
    place = lambda c: ((1 - root) * F.col(f"a{c}") + root * (1 - v) * F.col(f"b{c}") + root * v * F.col(f"c{c}")).alias(c)
    return at.select("slide_id", "k", place("x"), place("y"), "poly_id")


def random_patches(points: DataFrame, slides: DataFrame, cells: DataFrame, n: int, size: int, threshold: float = 0.3, least_score: float = 0.8, core: tuple[int, ...] = (0,), seed: int = 42, score: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The n best patches of each slide around sampled points (slide_id, k, x, y), moved by up to half a patch and into the slide.

    Scored by core points, or by the column `own_score` that the caller's function adds to the patches, cut at least_score, without those whose IoU with a better one is over the threshold. Adds the rank and a
    name `slide-nn-w_h-x_y`.
    """
    from nucleispark.operators.graph import best_patches, score_patches
    from nucleispark.operators.nms import nms_by_group

    shift = lambda salt: (F.pmod(F.xxhash64(F.lit(seed), "slide_id", "k", F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40)) - 0.5) * size
    begin = lambda c, side: F.greatest(F.lit(0), F.least(F.floor(F.col(c) + shift(c) - size / 2).cast("int"), F.col(side).cast("int") - size))
    patches = points.join(slides.select("slide_id", "h", "w"), "slide_id").select("slide_id", F.col("k").alias("patch_id"), begin("x", "w").alias("x"), begin("y", "h").alias("y"))
    patches = patches.withColumns({"w": F.lit(size), "h": F.lit(size)})
    scored = score_patches(patches, cells, size, core)
    scored, by = (scored, "n_core") if score is None else (score(scored), "own_score")
    scored = scored.filter(F.col(by) >= least_score)
    boxes = scored.withColumns({"x0": F.col("x").cast("double"), "y0": F.col("y").cast("double"), "x1": (F.col("x") + F.col("w")).cast("double"), "y1": (F.col("y") + F.col("h")).cast("double"), "score": F.col(by).cast("double"), "nucleus_id": F.col("patch_id").cast("long")})
    best = best_patches(nms_by_group(boxes, ["slide_id"], threshold), n, by).drop("x0", "y0", "x1", "y1", "score", "nucleus_id")
    return best.withColumn("name", F.format_string("%s-%02d-%d_%d-%d_%d", F.col("slide_id").cast("string"), "rank", "w", "h", "x", "y"))
