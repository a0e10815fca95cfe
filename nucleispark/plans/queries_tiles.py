"""Queries on tile plans, requests and annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from nucleispark.functions import scalars as fn
from nucleispark.operators import annotations, boxes, density, predict, roi, tiles
from nucleispark.plans.fixtures import tables
from nucleispark.plans.registry import query
from nucleispark.session import on_workers
from nucleispark.streaming import batching
from nucleispark.streaming import requests as stream

_GRID = """grid AS (SELECT slide_id, CAST(c AS INT) AS tile_col, CAST(r AS INT) AS tile_row, CAST(c * 500 AS INT) AS x, CAST(r * 500 AS INT) AS y,
    CAST(least(500, 4096 - c * 500) AS INT) AS w, CAST(least(500, 4096 - r * 500) AS INT) AS h FROM slides, range(9) AS a(c), range(9) AS b(r))"""


def _plan(spark, sf_dir, patch: int = 500):
    (slides,) = tables(spark, sf_dir, "slides")
    return tiles.tile_grid(slides.select("slide_id", "h", "w"), patch)


@query(f"WITH {_GRID} SELECT * FROM grid", "slides")
def G1_tile_grid(spark, sf_dir):
    return _plan(spark, sf_dir).drop("slide_h", "slide_w")


@query(
    f"""WITH {_GRID}, p AS (SELECT *, greatest(x - 64, 0) AS src_x, greatest(y - 64, 0) AS src_y, least(x + w + 64, 4096) AS ex, least(y + h + 64, 4096) AS ey FROM grid)
      SELECT slide_id, tile_col, tile_row, src_x, src_y, ex - src_x AS src_w, ey - src_y AS src_h, src_x - x + 64 AS pad_l, x + w + 64 - ex AS pad_r, src_y - y + 64 AS pad_u, y + h + 64 - ey AS pad_d FROM p""",
    "slides",
)
def G2_pad_tiles(spark, sf_dir):
    return tiles.pad_tiles(_plan(spark, sf_dir), 64).drop("x", "y", "w", "h", "slide_h", "slide_w")


@query(f"WITH {_GRID} SELECT slide_id, tile_col, tile_row, CAST(tile_row * 9 + tile_col + 1 AS INT) AS ordinal, printf('%d_%05d', slide_id, tile_row * 9 + tile_col + 1) AS image_id FROM grid", "slides")
def W1_number_tiles(spark, sf_dir):
    return tiles.number_tiles(_plan(spark, sf_dir)).select("slide_id", "tile_col", "tile_row", "ordinal", "image_id")


@query(
    """WITH a AS (SELECT slide_id, mpp, CAST(round_even(512 * 0.25 / mpp / 64, 0) * 64 AS INT) AS "window" FROM slides)
      SELECT slide_id, "window", 512.0 / "window" AS scale, CAST(floor(64 / (512.0 / "window")) AS INT) AS pad, mpp / (512.0 / "window") AS run_mpp FROM a""",
    "slides",
)
def G3_inference_window(spark, sf_dir):
    return tiles.inference_window(*tables(spark, sf_dir, "slides")).select("slide_id", "window", "scale", "pad", "run_mpp")


_LEVELS = """levels AS (SELECT slide_id, CAST(l AS INT) AS level, CAST(ceil(3000 / pow(2, 12 - l)) AS INT) AS level_w, CAST(ceil(4096 / pow(2, 12 - l)) AS INT) AS level_h, pow(2, 12 - l) AS downsample FROM slides, range(13) AS r(l))"""


def _levels(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    return tiles.dz_levels(slides.select("slide_id", "h", F.lit(3000).alias("w")))


@query(f"WITH {_LEVELS} SELECT * FROM levels", "slides")
def G4_dz_levels(spark, sf_dir):
    return _levels(spark, sf_dir).drop("h", "w")


@query(
    f"""WITH {_LEVELS}, n AS (SELECT *, unnest(range(0, CAST(ceil(level_w / 254) AS BIGINT))) AS c FROM levels), m AS (SELECT *, unnest(range(0, CAST(ceil(level_h / 254) AS BIGINT))) AS r FROM n)
      SELECT slide_id, level, CAST(c AS INT) AS tile_col, CAST(r AS INT) AS tile_row, CAST(greatest(c * 254 - 1, 0) AS INT) AS x, CAST(greatest(r * 254 - 1, 0) AS INT) AS y,
        CAST(least((c + 1) * 254 + 1, level_w) - greatest(c * 254 - 1, 0) AS INT) AS w, CAST(least((r + 1) * 254 + 1, level_h) - greatest(r * 254 - 1, 0) AS INT) AS h,
        CAST(greatest(c * 254 - 1, 0) * downsample AS BIGINT) AS src_x, CAST(greatest(r * 254 - 1, 0) * downsample AS BIGINT) AS src_y FROM m""",
    "slides",
)
def G5_dz_tiles(spark, sf_dir):
    return tiles.dz_tiles(_levels(spark, sf_dir), 254, 1).select("slide_id", "level", "tile_col", "tile_row", "x", "y", "w", "h", "src_x", "src_y")


@query("SELECT slide_id, CAST(s AS BIGINT) AS scale FROM slides, (VALUES (2), (4), (8)) AS v(s)", "slides")
def G6_export_scales(spark, sf_dir):
    return tiles.export_scales(*tables(spark, sf_dir, "slides")).select("slide_id", "scale")


@query(
    f"""WITH {_LEVELS} SELECT slide_id, arg_min(level, {{'a': round(abs(ln(downsample / 3.0)), 12), 'l': level}}) AS nearest, arg_max(level, downsample) FILTER (downsample / 3.0 <= 1.01) AS below FROM levels GROUP BY slide_id""",
    "slides",
)
def K3_best_level(spark, sf_dir):
    levels = _levels(spark, sf_dir)
    return tiles.best_level(levels, 3.0).withColumnRenamed("level", "nearest").join(tiles.best_level(levels, 3.0, True).withColumnRenamed("level", "below"), "slide_id")


_ROI = "roi AS (SELECT DISTINCT slide_id, CAST(floor((y0 + y1) / 128) AS INT) AS gr, CAST(floor((x0 + x1) / 128) AS INT) AS gc, CAST(1 + CAST(label = 2 AS INT) AS INT) AS poly_id FROM detections WHERE label IN (1, 2))"


def _roi(dets):
    rows = dets.filter("label in (1, 2)")
    at = lambda a: F.floor((F.col(f"{a}0") + F.col(f"{a}1")) / 128).cast("int")
    return rows.select("slide_id", at("y").alias("gr"), at("x").alias("gc"), (1 + (F.col("label") == 2).cast("int")).alias("poly_id")).distinct()


_COVER = f"""{_ROI}, cell AS (SELECT slide_id, gr // 8 AS tile_row, gc // 8 AS tile_col, poly_id, count(*) AS n FROM roi GROUP BY ALL),
  whole AS (SELECT slide_id, gr // 8 AS tile_row, gc // 8 AS tile_col, count(DISTINCT gr * 1000 + gc) / 64 AS coverage FROM roi GROUP BY ALL),
  best AS (SELECT slide_id, tile_col, tile_row, coverage, arg_min(poly_id, {{'a': -n, 'p': poly_id}}) AS poly_id FROM cell JOIN whole USING (slide_id, tile_col, tile_row) GROUP BY ALL),
  every AS (SELECT slide_id, CAST(c AS INT) AS tile_col, CAST(r AS INT) AS tile_row FROM slides, range(8) AS a(c), range(8) AS b(r)),
  covered AS (SELECT slide_id, tile_col, tile_row, coalesce(coverage, 0.0) AS coverage, coalesce(poly_id, 0) AS poly_id FROM every LEFT JOIN best USING (slide_id, tile_col, tile_row))"""


@query(f"WITH {_COVER} SELECT * FROM covered WHERE coverage >= 1e-8", "slides", "detections")
def J6_select_tiles(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    return tiles.select_tiles(_plan(spark, sf_dir, 512), _roi(dets), 64).select("slide_id", "tile_col", "tile_row", "coverage", "poly_id")


@query(f"WITH {_COVER} SELECT slide_id, round(avg(coverage), 6) AS coverage, count(*) FILTER (coverage > 0) AS n_tiles FROM covered GROUP BY slide_id", "slides", "detections")
def A15_plan_summary(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    return tiles.plan_summary(tiles.tile_coverage(_plan(spark, sf_dir, 512), _roi(dets), 64)).withColumn("coverage", F.round("coverage", 6))


_NEAR = """near AS (SELECT DISTINCT slide_id, tile_col + c AS tile_col, tile_row + r AS tile_row FROM requests, range(-1, 2) AS a(c), range(-1, 2) AS b(r) WHERE tile_col + c BETWEEN 0 AND 7 AND tile_row + r BETWEEN 0 AND 7)"""


@query(f"WITH {_NEAR} SELECT * FROM near", "requests")
def J7_neighbor_tiles(spark, sf_dir):
    return tiles.neighbor_tiles(*tables(spark, sf_dir, "requests"), 8, 8)


_NEWEST = "newest AS (SELECT slide_id, tile_col, tile_row FROM requests QUALIFY row_number() OVER (PARTITION BY slide_id ORDER BY ts DESC, event_id DESC) = 1)"


@query(f"WITH {_NEWEST}, {_NEAR.replace('FROM requests', 'FROM newest')} SELECT * FROM near EXCEPT SELECT * FROM newest", "requests")
def U2_open_neighbors(spark, sf_dir):
    """Around each slide's newest request."""
    (rows,) = tables(spark, sf_dir, "requests")
    newest = rows.groupBy("slide_id").agg(F.max_by(F.struct("tile_col", "tile_row"), F.struct("ts", "event_id")).alias("t"))
    return tiles.neighbor_tiles(newest.select("slide_id", "t.tile_col", "t.tile_row"), 8, 8, others_only=True)


@query(
    """SELECT DISTINCT slide_id, tile_col + c AS tile_col, tile_row + r AS tile_row FROM requests, range(-1, 2) AS a(c), range(-1, 2) AS b(r) WHERE tile_col + c BETWEEN 0 AND 9 AND tile_row + r BETWEEN 0 AND 9
      EXCEPT SELECT slide_id, tile_col, tile_row FROM requests""",
    "requests",
)
def U2_open_neighbors_all(spark, sf_dir):
    """In a grid that goes on beyond the requested tiles."""
    (rows,) = tables(spark, sf_dir, "requests")
    return tiles.neighbor_tiles(rows.select("slide_id", "tile_col", "tile_row"), 10, 10, others_only=True)


@query(
    """SELECT s.slide_id, 64 AS total, count(DISTINCT CASE WHEN r.event_id IS NOT NULL THEN r.tile_col * 8 + r.tile_row END) AS finished,
      count(DISTINCT CASE WHEN r.event_id IS NOT NULL THEN r.tile_col * 8 + r.tile_row END) / 64.0E0 AS share FROM slides s LEFT JOIN requests r USING (slide_id) GROUP BY s.slide_id""",
    "slides", "requests",
)
def A14_progress(spark, sf_dir):
    (rows,) = tables(spark, sf_dir, "requests")
    return tiles.progress(_plan(spark, sf_dir, 512), rows).withColumn("total", F.col("total").cast("int"))


@query("SELECT slide_id, event_id FROM requests QUALIFY row_number() OVER (PARTITION BY slide_id ORDER BY ts DESC, event_id DESC) <= 32", "requests")
def K4_newest_requests(spark, sf_dir):
    return tiles.newest_requests(*tables(spark, sf_dir, "requests")).select("slide_id", "event_id")


@query(
    """WITH p AS (SELECT d.slide_id, d.nucleus_id, d.x0, d.y0, d.x1, d.y1, (d.x0 + d.x1) / 2 AS xc, (d.y0 + d.y1) / 2 AS yc FROM detections d JOIN slides USING (slide_id))
      SELECT slide_id, nucleus_id, x0, y0, x1, y1 FROM p WHERE xc % 512 > 0 AND yc % 512 > 0 AND xc < 4096 AND yc < 4096""",
    "detections", "slides",
)
def P4_tile_to_slide(spark, sf_dir):
    """Every nucleus is found in each padded tile that holds its centre; the trim leaves it once."""
    (dets,) = tables(spark, sf_dir, "detections")
    return boxes.tile_to_slide(_seen_in_tiles(spark, sf_dir, dets), _padded(spark, sf_dir)).select("slide_id", "nucleus_id", "x0", "y0", "x1", "y1")


def _padded(spark, sf_dir):
    return tiles.pad_tiles(_plan(spark, sf_dir, 512), 64).withColumns({"pad_l": F.lit(64), "pad_u": F.lit(64)})


def _seen_in_tiles(spark, sf_dir, dets):
    """What a detector sees in padded tiles: boxes whose centre is in the window, relative to it."""
    xc, yc = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    reach = lambda c: F.sequence(F.floor((c - 64) / 512), F.floor((c + 64) / 512))
    near = dets.withColumn("tile_col", F.explode(reach(xc))).withColumn("tile_row", F.explode(reach(yc))).filter("tile_col between 0 and 7 and tile_row between 0 and 7")
    left, up = F.col("tile_col") * 512 - 64, F.col("tile_row") * 512 - 64
    return near.withColumns({"x0": F.col("x0") - left, "x1": F.col("x1") - left, "y0": F.col("y0") - up, "y1": F.col("y1") - up})


@query("SELECT d.slide_id, nucleus_id, (x0 - 12) / 2 AS x0, (y0 - 31) / 2 AS y0, (x1 - 12) / 2 AS x1, (y1 - 31) / 2 AS y1 FROM detections d JOIN slides USING (slide_id)", "detections", "slides")
def P5_patch_to_image(spark, sf_dir):
    """Patches of 961 x 1000 pixels were padded to 1024 x 1024 after scaling by 2."""
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    patches = slides.select("slide_id", F.lit(961).alias("h"), F.lit(1000).alias("w"), F.lit(2.0).alias("scale"))
    return boxes.patch_to_image(dets, patches).drop("label", "score")


_POLYS = """polys AS (SELECT slide_id, CAST(k AS INT) AS poly_id, [{'x': 100.5 + 900 * k, 'y': 200.5}, {'x': 800.5 + 900 * k, 'y': 400.5}, {'x': 700.5 + 900 * k, 'y': 1500.5}, {'x': 350.5 + 900 * k, 'y': 700.5}] AS v FROM slides, range(4) AS r(k))"""


def _polygons(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    corner = lambda x, y: F.struct((F.lit(x) + 900 * F.col("poly_id")).alias("x"), F.lit(y).alias("y"))
    rows = slides.withColumn("poly_id", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return rows.select("slide_id", "poly_id", "h", "w", F.array(corner(100.5, 200.5), corner(800.5, 400.5), corner(700.5, 1500.5), corner(350.5, 700.5)).alias("vertices"))


@query(
    f"""WITH {_POLYS}, e AS (SELECT slide_id, poly_id, unnest(list_zip(v, list_concat(v[2:], v[1:1]))) AS s FROM polys), p AS (SELECT slide_id, nucleus_id, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM detections)
      SELECT p.slide_id, nucleus_id, poly_id FROM p JOIN e USING (slide_id) WHERE (s[1].y > p.y) <> (s[2].y > p.y) AND p.x < (s[2].x - s[1].x) * (p.y - s[1].y) / (s[2].y - s[1].y) + s[1].x
      GROUP BY p.slide_id, nucleus_id, poly_id HAVING count(*) % 2 = 1""",
    "slides", "detections",
)
def J8_points_in_polygons(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    points = dets.select("slide_id", "nucleus_id", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    return roi.points_in_polygons(points, _polygons(spark, sf_dir), 512).select("slide_id", "nucleus_id", "poly_id")


@query(
    f"""WITH {_POLYS}, e AS (SELECT slide_id, poly_id, unnest(list_zip(v, list_concat(v[2:], v[1:1]))) AS s FROM polys),
      p AS (SELECT slide_id, CAST(c AS INT) AS tile_col, CAST(r AS INT) AS tile_row, i, j, c * 512 + (i + 0.5) * 32 AS x, r * 512 + (j + 0.5) * 32 AS y FROM slides, range(8) AS a(c), range(8) AS b(r), range(16) AS d(i), range(16) AS g(j)),
      h AS (SELECT p.slide_id, tile_col, tile_row, i, j, poly_id FROM p JOIN e USING (slide_id) WHERE (s[1].y > p.y) <> (s[2].y > p.y) AND p.x < (s[2].x - s[1].x) * (p.y - s[1].y) / (s[2].y - s[1].y) + s[1].x GROUP BY ALL HAVING count(*) % 2 = 1),
      n AS (SELECT slide_id, tile_col, tile_row, poly_id, count(*) AS n FROM h GROUP BY ALL), m AS (SELECT slide_id, tile_col, tile_row, arg_min(poly_id, {{'a': -n, 'b': poly_id}}) AS poly_id FROM n GROUP BY ALL),
      share AS (SELECT slide_id, tile_col, tile_row, count(DISTINCT (i, j)) / 256 AS coverage FROM h GROUP BY ALL)
      SELECT t.slide_id, CAST(c AS INT) AS tile_col, CAST(r AS INT) AS tile_row, coalesce(coverage, 0) AS coverage, coalesce(poly_id, 0) AS poly_id FROM (SELECT slide_id, c, r FROM slides, range(8) AS a(c), range(8) AS b(r)) AS t
      LEFT JOIN m ON m.slide_id = t.slide_id AND m.tile_col = c AND m.tile_row = r LEFT JOIN share s ON s.slide_id = t.slide_id AND s.tile_col = c AND s.tile_row = r""",
    "slides",
)
def J6_polygon_coverage(spark, sf_dir):
    """Tiles by the share of 16 x 16 points that polygons hold."""
    (slides,) = tables(spark, sf_dir, "slides")
    grid = tiles.tile_grid(slides.select("slide_id", "h", "w"), 512)
    found = tiles.polygon_coverage(grid, _polygons(spark, sf_dir), 16)
    return found.select("slide_id", "tile_col", "tile_row", "coverage", "poly_id")


@query(
    f"""WITH {_POLYS} SELECT slide_id, poly_id, len(v) - 2 AS n, round(abs(list_sum(list_transform(list_zip(v, list_concat(v[2:], v[1:1])), lambda s: s[1].x * s[2].y - s[2].x * s[1].y))) / 2, 6) AS area FROM polys""",
    "slides",
)
def G7_polygon_triangles(spark, sf_dir):
    """Triangles make up their polygon."""
    on_workers(spark)
    return roi.polygon_triangles(_polygons(spark, sf_dir)).groupBy("slide_id", "poly_id").agg(F.count("*").alias("n"), F.round(F.sum("area"), 6).alias("area"))


@query("SELECT slide_id, 400 AS n, 400 AS inside, 1 AS first_k, 400 AS last_k FROM slides", "slides")
def G7_sample_in_polygons(spark, sf_dir):
    """As many points as asked for, all inside."""
    on_workers(spark)
    polygons = _polygons(spark, sf_dir)
    points = roi.sample_in_polygons(polygons, 400)
    inside = roi.points_in_polygons(points.drop("poly_id"), polygons, 512).select("slide_id", "k").distinct().withColumn("_in", F.lit(1))
    return points.join(inside, ["slide_id", "k"], "left").groupBy("slide_id").agg(F.count("*").alias("n"), F.count("_in").alias("inside"), F.min("k").alias("first_k"), F.max("k").alias("last_k"))


@query(
    f"""WITH {_POLYS}, f AS (SELECT slide_id, poly_id, list_transform(v, lambda p: {{'x': greatest(0, least((p.y) * 1.5, 4096 * 1.5)), 'y': greatest(0, least((4096 - p.x) * 1.5, 4096 * 1.5))}}) AS v FROM polys)
      SELECT slide_id, poly_id, v[1].x AS x, v[1].y AS y, round(abs(list_sum(list_transform(list_zip(v, list_concat(v[2:], v[1:1])), lambda s: s[1].x * s[2].y - s[2].x * s[1].y))) / 2, 6) AS area FROM f""",
    "slides",
)
def G15_flip_and_scale_polygons(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    turned = roi.flip_polygons(roi.flip_polygons(_polygons(spark, sf_dir), "x"), "t")
    scaled = roi.scale_polygons(slides, turned, 1.5)
    first = F.get("vertices", F.lit(0))
    return scaled.select("slide_id", "poly_id", first["x"].alias("x"), first["y"].alias("y"), F.round("area", 6).alias("area"))


@query(f"WITH {_POLYS}, a AS (SELECT slide_id, poly_id, CASE poly_id WHEN 0 THEN 'ROI' WHEN 1 THEN 'ROI_2' WHEN 2 THEN 'not ROI' ELSE 'roi' END AS label FROM polys) SELECT * FROM a WHERE label LIKE 'ROI%'", "slides")
def P8_filter_annotations(spark, sf_dir):
    named = _polygons(spark, sf_dir).withColumn("label", F.element_at(F.array(*map(F.lit, ("ROI", "ROI_2", "not ROI", "roi"))), F.col("poly_id") + 1))
    return annotations.roi_regions(named, "ROI").select("slide_id", "poly_id", "label")


@query("SELECT DISTINCT slide_id, tile_col, tile_row FROM requests", "requests")
def T1_requests_once(spark, sf_dir):
    return stream.once(*tables(spark, sf_dir, "requests")).select("slide_id", "tile_col", "tile_row")


@query("SELECT event_id, slide_id, tile_col + c AS tile_col, tile_row + r AS tile_row FROM requests, range(-1, 2) AS a(c), range(-1, 2) AS b(r) WHERE tile_col + c BETWEEN 0 AND 7 AND tile_row + r BETWEEN 0 AND 7", "requests")
def T2_request_neighbors(spark, sf_dir):
    return stream.with_neighbors(*tables(spark, sf_dir, "requests"), 8, 8).drop("ts")


@query(
    """WITH m AS (SELECT slide_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 10 SECOND THEN 0 ELSE 1 END AS new FROM requests WINDOW w AS (PARTITION BY slide_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY slide_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM m)
      SELECT slide_id, epoch_us(min(ts)) AS begin_us, epoch_us(max(ts)) + 10000000 AS end_us, count(*) AS n FROM s GROUP BY slide_id, k""",
    "requests",
)
def T6_service_runs(spark, sf_dir):
    runs = stream.service_runs(*tables(spark, sf_dir, "requests"))
    return runs.select("slide_id", F.unix_micros(F.col("begin").cast("timestamp")).alias("begin_us"), F.unix_micros(F.col("end").cast("timestamp")).alias("end_us"), "n")


@query(
    """SELECT slide_id, tile_col, tile_row, CAST(round(xc, 3) AS DOUBLE) AS xc, CAST(round(yc, 3) AS DOUBLE) AS yc, label FROM (
      SELECT slide_id, CAST(c AS INT) AS tile_col, CAST(r AS INT) AS tile_row, c * 512 + k * 100 + 40.5 AS xc, r * 512 + k * 90 + 20.5 AS yc, CAST(k % 3 + 1 AS INT) AS label
      FROM slides, range(8) AS a(c), range(8) AS b(r), range(5) AS d(k))""",
    "slides",
)
def F1_detect_slides(spark, sf_dir):
    """A planted detector: five nuclei in each tile, seen again in the padding of its neighbours, and one doubled with a lower score."""
    on_workers(spark)
    found = predict.detect_slides(_padded(spark, sf_dir), planted_detector, 0.2, 0.5, 1000)
    xc, yc = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return found.select("slide_id", F.floor(xc / 512).cast("int").alias("tile_col"), F.floor(yc / 512).cast("int").alias("tile_row"), F.round(xc, 3).alias("xc"), F.round(yc, 3).alias("yc"), "label")


def planted_detector():
    import pandas as pd

    def detect(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for t in pdf.itertuples():
            n = 0
            for dc in (-1, 0, 1):
                for dr in (-1, 0, 1):
                    for k in range(5):
                        x, y = dc * 512 + k * 100 + 40.5 + 64, dr * 512 + k * 90 + 20.5 + 64
                        if 0 <= x < 640 and 0 <= y < 640:
                            for worse in (0, 1):
                                rows.append((t.slide_id, t.tile_col, t.tile_row, n, x - 8 + worse, y - 8, x + 8 + worse, y + 8, k % 3 + 1, 0.9 - 0.4 * worse))
                                n += 1
        return pd.DataFrame(rows, columns=[c.split()[0] for c in predict.DETECTED.split(", ")])

    return detect


@query("SELECT slide_id, CAST(max(ceil(greatest(y0, y1))) + 1 AS INT) AS h, CAST(max(ceil(greatest(x0, x1))) + 1 AS INT) AS w FROM detections GROUP BY slide_id", "detections")
def A5_slide_extent(spark, sf_dir):
    return density.slide_extent(*tables(spark, sf_dir, "detections"))


@query("SELECT slide_id, tile_col, tile_row, CAST(0 AS BIGINT) AS level FROM (SELECT DISTINCT slide_id, tile_col, tile_row FROM requests)", "requests")
def Z6_tile_keys(spark, sf_dir):
    (rows,) = tables(spark, sf_dir, "requests")
    keys = rows.select("slide_id", fn.tile_key(F.lit(0), F.col("tile_col"), F.col("tile_row")).alias("k")).distinct()
    return keys.select("slide_id", fn.parse_tile_key(F.col("k")).alias("p")).select("slide_id", "p.*")


@query(
    """WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY ts, event_id) AS k FROM requests),
      b AS (SELECT slide_id, k, event_id, ts AS first, 1 AS batch, 1 AS place FROM r WHERE k = 1
        UNION ALL SELECT r.slide_id, r.k, r.event_id, CASE WHEN place >= 16 OR r.ts >= first + INTERVAL 12 HOUR THEN r.ts ELSE first END, CASE WHEN place >= 16 OR r.ts >= first + INTERVAL 12 HOUR THEN batch + 1 ELSE batch END,
          CASE WHEN place >= 16 OR r.ts >= first + INTERVAL 12 HOUR THEN 1 ELSE place + 1 END FROM b JOIN r ON r.slide_id = b.slide_id AND r.k = b.k + 1)
      SELECT slide_id, CAST(batch AS BIGINT) AS batch, place, event_id FROM b""",
    "requests",
)
def T3_request_batches(spark, sf_dir):
    """The requests replayed in batches of 16, or of 12 hours, as they are few."""
    on_workers(spark)
    return batching.batched_requests(*tables(spark, sf_dir, "requests"), 16, "12 hours").select("slide_id", "batch", "place", "event_id")
