"""Steps that must not send a grown side whole, or deal all rows by a few keys; results on uneven grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from nucleispark.operators import density, tiles

TILES = "slide_id long, tile_col int, tile_row int, x int, y int, w int, h int"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def grid(h: int, w: int, patch: int) -> list[tuple]:
    return [(1, c, r, c * patch, r * patch, min(patch, w - c * patch), min(patch, h - r * patch)) for r in range(-(-h // patch)) for c in range(-(-w // patch))]


def test_coverage_by_cells(spark):
    rows = grid(300, 420, 96)
    cells = [(1, (i * 7) % 40, (i * 5) % 30, i % 3) for i in range(500)]
    found = tiles.tile_coverage(spark.createDataFrame(rows, TILES), spark.createDataFrame(cells, "slide_id long, gr int, gc int, poly_id int").distinct(), 12)
    got = {(r["tile_col"], r["tile_row"]): (round(r["coverage"], 9), r["poly_id"]) for r in found.collect()}
    for _, c, r, x, y, w, h in rows:
        mine = {(gr, gc, p) for _, gr, gc, p in cells if y // 12 <= gr <= (y + h - 1) // 12 and x // 12 <= gc <= (x + w - 1) // 12}
        n = [sum(q == p for *_, q in mine) for p in range(3)]
        assert got[c, r] == (round(len({m[:2] for m in mine}) / (-(-w // 12) * -(-h // 12)), 9), n.index(max(n)) if mine else 0)


def test_tiles_of_many_slides_are_not_sent_whole(spark):
    """A few slides, as Spark sees them, that give many tiles and cells, against many cells of the region."""
    slides = spark.range(3).select(F.col("id").alias("slide_id"), F.lit(4096).alias("h"), F.lit(4096).alias("w"))
    cells = spark.range(10**8).select((F.col("id") % 3).alias("slide_id"), (F.col("id") % 64).cast("int").alias("gr"), F.floor(F.col("id") / 64).cast("int").alias("gc"))
    assert "BroadcastHashJoin" not in plan(tiles.tile_coverage(tiles.tile_grid(slides, 512), cells, 64))


def test_coverage_by_polygons(spark):
    rows = grid(100, 130, 40)
    shape = {0: [(3.0, 2.0), (90.0, 30.0), (50.0, 95.0), (20.0, 50.0)], 1: [(40.0, 10.0), (128.0, 20.0), (60.0, 60.0)]}
    polygons = spark.createDataFrame([(1, k, [{"x": x, "y": y} for x, y in v]) for k, v in shape.items()], "slide_id long, poly_id int, vertices array<struct<x:double,y:double>>")
    found = tiles.polygon_coverage(spark.createDataFrame(rows, TILES), polygons, 5)

    def holds(v, x, y):
        return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for (ax, ay), (bx, by) in zip(v, v[1:] + v[:1], strict=True)) % 2

    got = {(r["tile_col"], r["tile_row"]): (round(r["coverage"], 9), r["poly_id"]) for r in found.collect()}
    for _, c, r, x, y, w, h in rows:
        at = [(x + (i + 0.5) * w / 5, y + (j + 0.5) * h / 5) for i in range(5) for j in range(5)]
        inside = {k: {p for p in at if holds(v, *p)} for k, v in shape.items()}
        assert got[c, r] == (round(len(inside[0] | inside[1]) / 25, 9), 1 if len(inside[1]) > len(inside[0]) else 0)


def test_polygon_points_are_dealt_to_tasks(spark):
    """All tiles of slides from one small file were spread into points by one task."""
    slides = spark.range(40, numPartitions=1).select(F.col("id").alias("slide_id"), F.lit(64).alias("h"), F.lit(64).alias("w"))
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    polygons = slides.select("slide_id", F.lit(0).alias("poly_id"), F.array(corner(1.0, 1.0), corner(60.0, 9.0), corner(30.0, 50.0)).alias("vertices"))
    found = tiles.polygon_coverage(tiles.tile_grid(slides, 16), polygons, 4)
    assert "REPARTITION_BY_NUM" in plan(found)
    assert found.filter("coverage > 0").count() == 40 * found.filter("coverage > 0 and slide_id = 0").count() > 0


def test_small_tables_by_class_deal_no_rows(spark):
    cells = spark.range(1000).select((F.col("id") % 2).alias("slide_id"), (F.col("id") % 3).cast("int").alias("cls"), F.floor(F.col("id") / 40).cast("int").alias("gr"), (F.col("id") % 40).cast("int").alias("gc"), F.lit(1.0).alias("d"))
    taps = spark.createDataFrame([(c, 0, k, 0.5) for c in (0, 1) for k in (0, 1)], "cls int, dr int, dc int, weight double")
    sizes = spark.range(2).select(F.col("id").alias("slide_id"), F.lit(64).alias("gh"), F.lit(64).alias("gw"))
    smoothed = density.smooth_by_taps(cells, taps, sizes)
    colors = spark.createDataFrame([(0, 0, 255, 0)], "cls int, r int, g int, b int")
    scattered = density.scatter_cells(cells.withColumnsRenamed({"gr": "row", "gc": "col"}), colors, 8)
    for df in (smoothed, scattered):
        assert "SortMergeJoin [cls#" not in plan(df)
    assert smoothed.agg(F.sum("d")).first()[0] == 1000 - cells.filter("cls < 2 and gc = 0").count() / 2


def test_class_tables_deal_no_detections(spark):
    """Joined by label, all detections of a class were one task's."""
    from nucleispark.operators import boxes
    from nucleispark.plans import queries_boxes
    from nucleispark.sources import io

    dets = spark.range(1000).select((F.col("id") % 2).alias("slide_id"), F.col("id").alias("nucleus_id"), (F.col("id") % 9).cast("int").alias("label"), *(F.lit(1.5).alias(c) for c in ("x0", "y0", "x1", "y1", "score")))
    exported, colored = io.export_detections(dets, io.class_table(spark)), boxes.label_color(dets, io.class_table(spark))
    for df in (exported, colored):
        assert "SortMergeJoin [label#" not in plan(df) and df.count() == 1000
    assert exported.filter("label = 'tumor'").count() == colored.filter("g = 255 and r = 0").count() == 111
    found = plan(queries_boxes.S6_class_table(spark, "/root/testdata/sf0.001"))
    assert found.index("Join") < found.index("HashAggregate")  # counted below the join
