"""Tile plans: grids, read windows, pyramid levels, coverage by tissue, neighbours, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.functions.scalars import tile_key
from nucleispark.operators.batches import deal

OFFSETS = [(dc, dr) for dr in (-1, 0, 1) for dc in (-1, 0, 1)]
#: Cells a side of the squares in which tiles meet their cells.
BIN = 8


def tile_grid(slides: DataFrame, patch: int, box: tuple[Column, Column, Column, Column] | None = None) -> DataFrame:
    """Tiles (tile_col, tile_row, x, y, w, h) that cover the box (x0, y0, x1, y1; by default the slide) once; the last ones are clipped."""
    x0, y0, x1, y1 = box or (F.lit(0), F.lit(0), F.col("w"), F.col("h"))
    starts = lambda a, b: F.when(a < b, F.sequence(a.cast("int"), (b - 1).cast("int"), F.lit(patch))).otherwise(F.array().cast("array<int>"))
    rest = [c for c in slides.columns if c not in ("h", "w")]
    own = slides.select(*rest, F.col("h").alias("slide_h"), F.col("w").alias("slide_w"), x1.cast("int").alias("_x1"), y1.cast("int").alias("_y1"), starts(x0, x1).alias("_xs"), starts(y0, y1).alias("_ys"))
    cols = own.select("*", F.posexplode("_xs").alias("tile_col", "x"))
    rows = cols.select("*", F.posexplode("_ys").alias("tile_row", "y"))
    return rows.select(*rest, "slide_h", "slide_w", "tile_col", "tile_row", "x", "y", F.least(F.lit(patch), F.col("_x1") - F.col("x")).alias("w"), F.least(F.lit(patch), F.col("_y1") - F.col("y")).alias("h"))


def pad_tiles(tiles: DataFrame, pad: int) -> DataFrame:
    """Adds the padded window inside the slide (src_x, src_y, src_w, src_h) and what is missing of it (pad_l, pad_r, pad_u, pad_d)."""
    zero = F.lit(0)
    left, up = F.greatest(F.col("x") - pad, zero), F.greatest(F.col("y") - pad, zero)
    right, down = F.least(F.col("x") + F.col("w") + pad, F.col("slide_w")), F.least(F.col("y") + F.col("h") + pad, F.col("slide_h"))
    return tiles.withColumns({
        "src_x": left, "src_y": up, "src_w": right - left, "src_h": down - up,
        "pad_l": left - F.col("x") + pad, "pad_r": F.col("x") + F.col("w") + pad - right, "pad_u": up - F.col("y") + pad, "pad_d": F.col("y") + F.col("h") + pad - down,
    })


def number_tiles(tiles: DataFrame) -> DataFrame:
    """Adds ordinal, from 1 on in row-major order, and image_id `slide_00001`."""
    order = Window.partitionBy("slide_id").orderBy("tile_row", "tile_col")
    return tiles.withColumn("ordinal", F.row_number().over(order)).withColumn("image_id", F.format_string("%s_%05d", F.col("slide_id").cast("string"), F.col("ordinal")))


def inference_window(slides: DataFrame, window: int = 512, target: float = 0.25, multiple: int = 64, pad: int = 64) -> DataFrame:
    """Adds the window to read at the slide's mpp, the scale that brings it to `window`, the padding at that scale and the mpp of the run."""
    size = F.rint(F.lit(window * target) / F.col("mpp") / multiple) * multiple
    return slides.withColumn("window", size.cast("int")).withColumn("scale", F.lit(float(window)) / F.col("window")).withColumns({"pad": F.floor(F.lit(pad) / F.col("scale")).cast("int"), "run_mpp": F.col("mpp") / F.col("scale")})


def dz_levels(slides: DataFrame) -> DataFrame:
    """Deep-zoom levels: sides halved, rounded up, down to 1 x 1, which is level 0. Adds level, level_w, level_h, downsample."""
    top = F.ceil(F.log2(F.greatest("w", "h").cast("double"))).cast("int")
    rows = slides.withColumn("_top", top).withColumn("level", F.explode(F.sequence(F.lit(0), F.col("_top"))))
    down = F.pow(F.lit(2.0), F.col("_top") - F.col("level"))
    side = lambda c: F.ceil(F.col(c) / down).cast("int")
    return rows.withColumns({"level_w": side("w"), "level_h": side("h"), "downsample": down}).drop("_top")


def dz_tiles(levels: DataFrame, size: int, overlap: int) -> DataFrame:
    """Tiles of each level with their overlapping windows in the level (x, y, w, h) and in the slide (src_x, src_y)."""
    n = lambda c: F.sequence(F.lit(0), F.ceil(F.col(c) / size).cast("int") - 1)
    rows = levels.withColumn("tile_col", F.explode(n("level_w"))).withColumn("tile_row", F.explode(n("level_h")))
    begin = lambda c: F.greatest(F.col(c) * size - overlap, F.lit(0))
    end = lambda c, side: F.least((F.col(c) + 1) * size + overlap, F.col(side))
    rows = rows.withColumns({"x": begin("tile_col"), "y": begin("tile_row"), "w": end("tile_col", "level_w") - begin("tile_col"), "h": end("tile_row", "level_h") - begin("tile_row")})
    return rows.withColumns({"src_x": (F.col("x") * F.col("downsample")).cast("long"), "src_y": (F.col("y") * F.col("downsample")).cast("long")})


def export_scales(slides: DataFrame, limit: int = 512) -> DataFrame:
    """Scales 2, 4, .. of an exported pyramid while a side of the previous level is over the limit."""
    most = F.greatest("w", "h")
    ks = F.filter(F.sequence(F.lit(1), F.lit(32)), lambda k: F.floor(most / F.pow(F.lit(2.0), k - 1)) > limit)
    return slides.withColumn("scale", F.explode(F.transform(ks, lambda k: F.pow(F.lit(2.0), k).cast("long"))))


def best_level(levels: DataFrame, factor: float, from_above: bool = False) -> DataFrame:
    """(slide_id, level): the level whose downsample is nearest to the factor by ratio, of equal ones the first; or from_above,
    the coarsest at most 1.01 times the factor."""
    if from_above:
        fits = levels.filter(F.col("downsample") / factor <= 1.01)
        return fits.groupBy("slide_id").agg(F.max_by("level", "downsample").alias("level"))
    return levels.groupBy("slide_id").agg(F.min_by("level", F.struct(F.round(F.abs(F.log(F.col("downsample") / factor)), 12), "level")).alias("level"))


def tile_coverage(tiles: DataFrame, roi_cells: DataFrame, cell: int) -> DataFrame:
    """Adds coverage, the share of each tile's cells of `cell` pixels that are in the ROI (slide_id, gr, gc), and poly_id, the region
    with most of them (0 if roi_cells has none or names none). A cell of several regions counts once. Tiles begin on cell borders."""
    regions = roi_cells if "poly_id" in roi_cells.columns else roi_cells.withColumn("poly_id", F.lit(0))
    key, part = ["slide_id", "tile_col", "tile_row"], ["slide_id", "_br", "_bc"]
    per = F.ceil(F.col("w") / cell) * F.ceil(F.col("h") / cell)
    last = lambda a, n: F.floor((F.col(a) + F.col(n) - 1) / cell)
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / BIN), F.floor(F.col(b) / BIN)))
    spans = deal(tiles, "slide_id").select(*key, per.alias("cells"), F.floor(F.col("y") / cell).alias("_r0"), last("y", "h").alias("_r1"), F.floor(F.col("x") / cell).alias("_c0"), last("x", "w").alias("_c1"))
    listed = spans.withColumn("_br", bins("_r0", "_r1")).withColumn("_bc", bins("_c0", "_c1"))
    # Tiles and cells meet in squares of cells; neither side is sent whole, as tiles are many more than the slides that Spark sees.
    cells = regions.select("slide_id", "gr", "gc", "poly_id", F.floor(F.col("gr") / BIN).alias("_br"), F.floor(F.col("gc") / BIN).alias("_bc"))
    hit = cells.join(listed.hint("shuffle_hash"), part).filter("gr between _r0 and _r1 and gc between _c0 and _c1")
    own = [*part, "tile_col", "tile_row"]
    share = hit.select(*own, "cells", "gr", "gc").distinct().groupBy(*own, "cells").agg(F.count("*").alias("n")).groupBy(*key, "cells").agg(F.sum("n").alias("n")).select(*key, (F.col("n") / F.col("cells")).alias("coverage"))
    most = hit.groupBy(*key, "poly_id").agg(F.count("*").alias("n")).groupBy(*key).agg(F.min_by("poly_id", F.struct(-F.col("n"), "poly_id")).alias("poly_id"))
    found = share.join(most, key)
    return tiles.join(found, key, "left").withColumns({"coverage": F.coalesce("coverage", F.lit(0.0)), "poly_id": F.coalesce("poly_id", F.lit(0))})


def polygon_coverage(tiles: DataFrame, polygons: DataFrame, samples: int = 16) -> DataFrame:
    """Adds coverage and poly_id by polygons (slide_id, poly_id, vertices): the share of each tile's samples * samples evenly spread
    points that any of them holds, and the one that holds most (0 if none does; of equal ones the least)."""
    from nucleispark.operators.roi import odd_crossings, polygon_edges

    key = ["slide_id", "tile_col", "tile_row"]
    size = int(tiles.agg(F.max(F.greatest("w", "h"))).first()[0] or 1)
    at = lambda c, n, i: F.col(c) + (i + 0.5) * F.col(n) / samples
    bins = lambda c, n: F.explode(F.sequence(F.floor(at(c, n, F.lit(0)) / size), F.floor(at(c, n, F.lit(samples - 1)) / size)))
    listed = tiles.select(*key, "x", "y", "w", "h").withColumn("_bx", bins("x", "w")).withColumn("_by", bins("y", "h"))
    on = ["slide_id", "_bx", "_by"]
    near = deal(listed, *on).join(deal(polygon_edges(polygons, size), *on), on)
    # The points of a tile and bin are one array of their numbers, of which those stay that the polygon holds.
    i, j = (lambda k: F.floor(k / samples)), (lambda k: k % samples)
    mine = lambda k: (F.floor(at("x", "w", i(k)) / size) == F.col("_bx")) & (F.floor(at("y", "h", j(k)) / size) == F.col("_by"))
    held = F.filter(F.sequence(F.lit(0), F.lit(samples * samples - 1)), lambda k: mine(k) & odd_crossings(at("x", "w", i(k)), at("y", "h", j(k)), F.col("_edges")))
    held = near.select(*key, "poly_id", held.alias("_held")).filter(F.size("_held") > 0).groupBy(*key, "poly_id").agg(F.flatten(F.collect_list("_held")).alias("_held"))
    any_of = F.size(F.array_distinct(F.flatten(F.collect_list("_held")))) / (samples * samples)
    found = held.groupBy(*key).agg(any_of.alias("coverage"), F.min_by("poly_id", F.struct(-F.size("_held"), "poly_id")).alias("poly_id"))
    joined = tiles.join(found, key, "left")
    return joined.withColumns({"coverage": F.coalesce("coverage", F.lit(0.0)), "poly_id": F.coalesce("poly_id", F.lit(0))})


def select_tiles(tiles: DataFrame, roi_cells: DataFrame, cell: int, threshold: float = 1e-8) -> DataFrame:
    return tile_coverage(tiles, roi_cells, cell).filter(F.col("coverage") >= threshold)


def plan_summary(covered: DataFrame) -> DataFrame:
    """(slide_id, coverage, n_tiles): mean coverage of all tiles, and how many have any."""
    return covered.groupBy("slide_id").agg(F.avg("coverage").alias("coverage"), F.count_if(F.col("coverage") > 0).alias("n_tiles"))


def neighbor_tiles(keys: DataFrame, n_cols: int, n_rows: int, others_only: bool = False) -> DataFrame:
    """Distinct tiles of the 3 x 3 neighbourhoods of (slide_id, tile_col, tile_row) within the grid; others_only: without the given ones."""
    offsets = F.array(*(F.struct(F.lit(c).alias("dc"), F.lit(r).alias("dr")) for c, r in OFFSETS))
    near = keys.select("slide_id", "tile_col", "tile_row", F.inline(offsets))
    near = near.select("slide_id", (F.col("tile_col") + F.col("dc")).alias("tile_col"), (F.col("tile_row") + F.col("dr")).alias("tile_row"))
    near = near.filter(F.col("tile_col").between(0, n_cols - 1) & F.col("tile_row").between(0, n_rows - 1)).distinct()
    return near.join(keys, ["slide_id", "tile_col", "tile_row"], "left_anti") if others_only else near


def progress(tiles: DataFrame, done: DataFrame) -> DataFrame:
    """(slide_id, total, finished, share) of planned tiles."""
    key = ["slide_id", "tile_col", "tile_row"]
    marked = tiles.select(*key).distinct().join(done.select(*key).distinct().withColumn("_done", F.lit(1)), key, "left")
    counted = marked.groupBy("slide_id").agg(F.count("*").alias("total"), F.count("_done").alias("finished"))
    return counted.withColumn("share", F.col("finished") / F.col("total"))


def newest_requests(requests: DataFrame, n: int = 32) -> DataFrame:
    """The newest n requests of each slide; later events first among equal times."""
    order = Window.partitionBy("slide_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return requests.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def with_key(tiles: DataFrame, level: int = 0) -> DataFrame:
    return tiles.withColumn("tile_key", tile_key(F.lit(level), F.col("tile_col"), F.col("tile_row")))
