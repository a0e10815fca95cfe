"""Queries on masks and pixel tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from nucleispark.functions.scalars import polygon_area
from nucleispark.operators import boxes, masks, pixels, raster
from nucleispark.plans.fixtures import tables
from nucleispark.plans.registry import query
from nucleispark.session import on_workers

_RUNS = """g AS (SELECT vec_id, x * 8 + y AS p, v > 0 AS on_ FROM pixels), c AS (SELECT *, CASE WHEN on_ <> coalesce(lag(on_) OVER (PARTITION BY vec_id ORDER BY p), false) THEN 1 ELSE 0 END AS new FROM g),
  r AS (SELECT *, sum(new) OVER (PARTITION BY vec_id ORDER BY p) AS run FROM c), n AS (SELECT vec_id, run, CAST(count(*) AS INT) AS n, any_value(on_) AS on_ FROM r GROUP BY ALL),
  runs AS (SELECT vec_id, CASE WHEN bool_or(run = 0) THEN list(n ORDER BY run) ELSE list_prepend(0, list(n ORDER BY run)) END AS counts FROM n GROUP BY vec_id)"""


def _pixels(spark, sf_dir):
    return tables(spark, sf_dir, "pixels")[0].withColumn("mask", F.col("v") > 0)


@query(f"WITH {_RUNS} SELECT vec_id, array_to_string(counts, ',') AS counts FROM runs", "pixels")
def W3_rle_encode(spark, sf_dir):
    return masks.rle_encode(_pixels(spark, sf_dir), "vec_id", 8).select("vec_id", F.array_join("counts", ",").alias("counts"))


@query("SELECT vec_id, y, x FROM pixels WHERE v > 0", "pixels")
def W4_rle_decode(spark, sf_dir):
    return masks.rle_decode(masks.rle_encode(_pixels(spark, sf_dir), "vec_id", 8), "vec_id", 8)


@query("SELECT vec_id, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1, count(*) AS area FROM pixels WHERE v > 0 GROUP BY vec_id", "pixels")
def A18_mask_bbox(spark, sf_dir):
    return masks.mask_bbox(_pixels(spark, sf_dir).filter("mask"), ["vec_id"])


@query(
    f"""WITH {_RUNS}, b AS (SELECT vec_id, any_value(label) AS label, min(x) AS x0, min(y) AS y0, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h, count(*) AS n FROM pixels WHERE v > 0 GROUP BY vec_id)
      SELECT vec_id AS id, '{{"id":' || vec_id || ',"image_id":' || vec_id // 10 || ',"category_id":' || label || ',"segmentation":[' || array_to_string(counts, ',') || '],"area":' || CAST(n AS DOUBLE) || ',"bbox":[' || x0 || ',' || y0 || ',' || w || ',' || h || '],"iscrowd":1}}' AS json
      FROM b JOIN runs USING (vec_id)""",
    "pixels",
)
def S12_to_coco(spark, sf_dir):
    rows = _pixels(spark, sf_dir).select(F.col("vec_id").alias("id"), F.expr("vec_id div 10").alias("image_id"), "label", "y", "x", "mask")
    return masks.to_coco(rows, 8, 8)


@query("SELECT vec_id AS id, vec_id // 10 AS image_id, label, y, x FROM pixels WHERE v > 0", "pixels")
def S12_from_coco(spark, sf_dir):
    rows = _pixels(spark, sf_dir).select(F.col("vec_id").alias("id"), F.expr("vec_id div 10").alias("image_id"), "label", "y", "x", "mask")
    return masks.from_coco(masks.to_coco(rows, 8, 8), 8)


_LABELS = "SELECT vec_id, label, CAST(floor((v + 1) * 2) AS INT) % 4 AS truth, CAST(floor((v + 1.1) * 2) AS INT) % 4 AS predicted FROM pixels"


@query(
    f"""WITH l AS ({_LABELS}), c AS (SELECT label, k, count(*) FILTER (truth = k AND predicted = k) AS i, count(*) FILTER (truth = k OR predicted = k) AS u FROM l, range(4) AS r(k) GROUP BY ALL)
      SELECT label, CAST(k AS INT) AS cls, round(i / u, 9) AS iou, round(2 * i / (u + i), 9) AS dice FROM c WHERE u > 0""",
    "pixels",
)
def A16_iou_by_class(spark, sf_dir):
    level = lambda by: (F.floor((F.col("v") + by) * 2).cast("int") % 4)
    rows = _pixels(spark, sf_dir).select("label", level(1.0).alias("truth"), level(1.1).alias("predicted"))
    return masks.iou_by_class(rows, ["label"]).select("label", "cls", F.round("iou", 9).alias("iou"), F.round("dice", 9).alias("dice"))


@query(
    """WITH i AS (SELECT vec_id, label % 3 + 1 AS label, y, x FROM pixels WHERE v > 0.2 UNION ALL SELECT vec_id, label % 3 + 1, y, x FROM pixels WHERE v > 0.4), u AS (SELECT DISTINCT * FROM i)
      SELECT * FROM u UNION ALL SELECT vec_id, 0, y, x FROM pixels ANTI JOIN u USING (vec_id, y, x)""",
    "pixels",
)
def U4_semantic_masks(spark, sf_dir):
    rows = _pixels(spark, sf_dir)
    part = lambda t: rows.filter(F.col("v") > t).select("vec_id", (F.col("label") % 3 + 1).alias("label"), "y", "x")
    return masks.semantic_masks(part(0.2).unionByName(part(0.4)), rows, "vec_id")


@query("SELECT vec_id, y, x, CAST(3 * (v > 0.1)::INT + 4 * (v > 0.3)::INT AS INT) AS value FROM pixels WHERE v > 0.1", "pixels")
def M3_merge_masks(spark, sf_dir):
    rows = _pixels(spark, sf_dir)
    part = lambda t, k: rows.filter(F.col("v") > t).select("vec_id", F.lit(k).alias("instance"), "y", "x")
    return masks.merge_masks(part(0.1, 3).unionByName(part(0.3, 4)), "vec_id")


@query(
    """WITH RECURSIVE s AS (SELECT vec_id, CASE WHEN v > 0.1 THEN 1 WHEN v < -0.1 THEN 2 END AS value, y, x, y * 8 + x AS p FROM pixels WHERE abs(v) > 0.1),
      near AS (SELECT vec_id, p, p AS q FROM s UNION SELECT n.vec_id, n.p, b.p FROM near n JOIN s a ON a.vec_id = n.vec_id AND a.p = n.q JOIN s b ON b.vec_id = a.vec_id AND b.value = a.value AND abs(a.y - b.y) + abs(a.x - b.x) = 1),
      root AS (SELECT vec_id, p, min(q) AS root FROM near GROUP BY ALL), big AS (SELECT vec_id, root FROM root GROUP BY ALL HAVING count(*) > 1),
      num AS (SELECT b.vec_id, b.root, s.value, row_number() OVER (PARTITION BY b.vec_id ORDER BY s.value, b.root) AS instance FROM big b JOIN s ON s.vec_id = b.vec_id AND s.p = b.root)
      SELECT s.vec_id, s.value, CAST(instance AS INT) AS instance, s.y, s.x FROM s JOIN root r ON r.vec_id = s.vec_id AND r.p = s.p JOIN num ON num.vec_id = r.vec_id AND num.root = r.root""",
    "pixels",
)
def M3_split_masks(spark, sf_dir):
    on_workers(spark)
    rows = _pixels(spark, sf_dir).withColumn("value", F.when(F.col("v") > 0.1, 1).when(F.col("v") < -0.1, 2).otherwise(0))
    return masks.split_masks(rows, "vec_id", 8, 8)


@query("SELECT vec_id, CAST(y AS INT) AS y, CAST(x AS INT) AS x FROM pixels WHERE v > 0", "pixels")
def M1_mask_polygons(spark, sf_dir):
    """Contours of masks as polygons, outer and inner rings, and their pixels again, which are the mask's."""
    on_workers(spark)
    rings = masks.pixels_to_polygons(_pixels(spark, sf_dir).filter("mask"), "vec_id", 8, 8)
    return masks.polygons_to_pixels(rings.select("vec_id", "vertices"), "vec_id", 8, 8)


# Each nucleus as a slanted six-cornered shape with corners between pixels and on them.
_HEX = """[{'x': x0 + (x1 - x0) / 4, 'y': y0}, {'x': x1, 'y': y0 + (y1 - y0) / 3}, {'x': x1 - 2, 'y': y1 - 1.25E0}, {'x': x0 + (x1 - x0) / 2, 'y': y1}, {'x': x0 + 1, 'y': y1}, {'x': x0, 'y': (y0 + y1) / 2}]"""
_FILL = f"""hexa AS (SELECT slide_id, nucleus_id, label, {_HEX} AS v FROM detections),
  edge AS (SELECT slide_id, nucleus_id, label, s[1].x AS ax, s[1].y AS ay, s[2].x AS bx, s[2].y AS by_ FROM (SELECT slide_id, nucleus_id, label, unnest(list_zip(v, list_concat(v[2:], v[1:1]))) AS s FROM hexa)),
  up AS (SELECT *, (bx - ax) * (y - ay) / (by_ - ay) + ax AS x FROM (SELECT *, unnest(range(CAST(ceil(least(ay, by_)) AS INT), CAST(floor(greatest(ay, by_)) AS INT) + 1)) AS y FROM edge WHERE ay <> by_)),
  spans AS (SELECT slide_id, nucleus_id, label, y, ceil(x) AS x0, ceil(lead(x) OVER w) - 1 AS x1, row_number() OVER w AS k FROM up WHERE y < greatest(ay, by_) WINDOW w AS (PARTITION BY slide_id, nucleus_id, y ORDER BY x)),
  drawn AS (SELECT slide_id, nucleus_id, label, y, CAST(x0 AS INT) AS x0, CAST(x1 AS INT) AS x1 FROM spans WHERE k % 2 = 1 AND x0 <= x1
    UNION ALL SELECT slide_id, nucleus_id, label, y, CAST(round(x) AS INT), CAST(round(x) AS INT) FROM up WHERE abs(x - round(x)) < 1e-9
    UNION ALL SELECT slide_id, nucleus_id, label, CAST(ay AS INT), CAST(ceil(least(ax, bx)) AS INT), CAST(floor(greatest(ax, bx)) AS INT) FROM edge WHERE ay = by_ AND ay = round(ay) AND ceil(least(ax, bx)) <= floor(greatest(ax, bx)))"""


# Each pixel once: of every run what lies beyond those before it.
_PX = """ahead AS (SELECT *, coalesce(max(x1) OVER (PARTITION BY slide_id, nucleus_id, y ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), x0 - 1) AS done FROM drawn),
  px AS (SELECT slide_id, nucleus_id, y, unnest(range(greatest(x0, done + 1), x1 + 1)) AS x FROM ahead WHERE x1 > done)"""


def _hexagons(dets):
    p = lambda x, y: F.struct(F.expr(x).alias("x"), F.expr(y).alias("y"))
    return F.array(p("x0 + (x1 - x0) / 4", "y0"), p("x1", "y0 + (y1 - y0) / 3"), p("x1 - 2", "y1 - 1.25E0"), p("x0 + (x1 - x0) / 2", "y1"), p("x0 + 1", "y1"), p("x0", "(y0 + y1) / 2"))


@query(
    f"""WITH {_FILL}, {_PX}
      SELECT slide_id, nucleus_id, count(*) AS n, CAST(sum(x) AS BIGINT) AS sx, CAST(sum(y) AS BIGINT) AS sy, CAST(sum(x * y) AS BIGINT) AS sxy FROM px GROUP BY ALL""",
    "detections",
)
def M1_polygon_fill(spark, sf_dir):
    """Sums over the pixels of each nucleus' polygon, drawn row by row."""
    on_workers(spark)
    (dets,) = tables(spark, sf_dir, "detections")
    key = ["slide_id", "nucleus_id"]
    runs = raster.filled_runs(dets.select(*key, _hexagons(dets).alias("vertices")), key)
    n, s = F.col("x1") - F.col("x0") + 1, (F.col("x0") + F.col("x1")) * (F.col("x1") - F.col("x0") + 1) / 2
    whole = lambda c: F.sum(c).cast("long")
    return runs.groupBy(*key).agg(whole(n).alias("n"), whole(s).alias("sx"), whole(n * F.col("y")).alias("sy"), whole(s * F.col("y")).alias("sxy"))


@query(
    f"""WITH {_FILL}, {_PX},
      m AS (SELECT slide_id, nucleus_id, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1, avg(x) AS xc, avg(y) AS yc, var_pop(y) + 1 / 12 AS a, var_pop(x) + 1 / 12 AS b, covar_pop(x, y) AS c FROM px GROUP BY ALL),
      e AS (SELECT *, (a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c * c) AS big, (a + b) / 2 - sqrt(((a - b) / 2) ** 2 + c * c) AS small FROM m)
      SELECT slide_id, nucleus_id, area, x0, y0, x1, y1, round(xc, 6) AS xc, round(yc, 6) AS yc, round(area / ((x1 - x0 + 1) * (y1 - y0 + 1)), 6) AS extent, round(sqrt(1 - small / big), 5) AS eccentricity, round(4 * sqrt(big), 6) AS major_axis_length,
        round(4 * sqrt(small), 6) AS minor_axis_length,
        round(CASE WHEN abs(a - b) < 1e-9 THEN CASE WHEN abs(c) < 1e-9 THEN 0 ELSE sign(c) * pi() / 4 END ELSE 0.5 * atan2(2 * CASE WHEN abs(c) < 1e-9 THEN 0 ELSE c END, a - b) END, 5) AS orientation FROM e""",
    "detections",
)
def D4_run_moments(spark, sf_dir):
    """Area, box, centre, axes, eccentricity, extent and orientation of each nucleus' polygon, by sums over its runs."""
    on_workers(spark)
    (dets,) = tables(spark, sf_dir, "detections")
    key = ["slide_id", "nucleus_id"]
    found = raster.run_moments(raster.filled_runs(dets.select(*key, _hexagons(dets).alias("vertices")), key), key)
    places = {"eccentricity": 5, "orientation": 5}
    return found.select(*key, "area", "x0", "y0", "x1", "y1", *(F.round(c, places.get(c, 6)).alias(c) for c in ("xc", "yc", "extent", "eccentricity", "major_axis_length", "minor_axis_length", "orientation")))


@query(None)
def D4_region_props(spark, sf_dir):
    """Vectors as soft masks of detections."""
    on_workers(spark)
    rows = tables(spark, sf_dir, "pixels")[0].groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("y", "x", "v"))).alias("s"), F.first("label").alias("label"))
    dets = rows.select("vec_id", "label", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), (12 + F.col("vec_id") % 9).cast("double").alias("x1"), (15 + F.col("vec_id") % 7).cast("double").alias("y1"), F.transform("s", lambda p: p["v"] + 0.5).alias("soft"))
    found = masks.region_props(dets, 8)
    return found.select("vec_id", *(F.round(c, 6).alias(c) for c in masks.NAMES))


@query("SELECT vec_id, min(v) AS low, max(v) AS high, count(DISTINCT v) AS n_values FROM pixels GROUP BY vec_id", "pixels")
def A17_image_stats(spark, sf_dir):
    return pixels.image_stats(_pixels(spark, sf_dir), "vec_id")


_RGB = "rgb AS (SELECT vec_id, y, x, CAST(floor((v + 1) * 127) AS DOUBLE) AS r, CAST(floor((v + 1) * 101) AS DOUBLE) AS g, CAST(floor((v + 1) * 83) AS DOUBLE) AS b FROM pixels)"


def _rgb(spark, sf_dir):
    channel = lambda k: F.floor((F.col("v") + 1) * k).cast("double")
    return _pixels(spark, sf_dir).select("vec_id", "y", "x", channel(127).alias("r"), channel(101).alias("g"), channel(83).alias("b"))


@query(f"WITH {_RGB} SELECT vec_id, y, x, " + ", ".join(f"round(CASE WHEN x % 3 = 0 THEN 1 ELSE {c} / 255 * (x % 3 / 2.0E0) + 1 - x % 3 / 2.0E0 END, 9) AS {c}" for c in "rgb") + " FROM rgb", "pixels")
def X1_rgba_to_rgb(spark, sf_dir):
    rows = _rgb(spark, sf_dir).withColumns({c: F.col(c) / 255 for c in "rgb"}).withColumn("a", (F.col("x") % 3) / 2)
    return pixels.rgba_to_rgb(rows).select("vec_id", "y", "x", *(F.round(c, 9).alias(c) for c in "rgb"))


@query(f"WITH {_RGB} SELECT vec_id, y, x, round(r * 0.2125 + g * 0.7154 + b * 0.0721, 6) AS gray FROM rgb", "pixels")
def X2_rgb_to_gray(spark, sf_dir):
    return pixels.rgb_to_gray(_rgb(spark, sf_dir)).select("vec_id", "y", "x", F.round("gray", 6).alias("gray"))


@query(f"WITH {_RGB} SELECT vec_id, y, x, " + ", ".join(f"round(1 - ln({c} + 1) / ln(256), 9) AS {c}, {c} AS back_{c}" for c in "rgb") + " FROM rgb", "pixels")
def X3_optical_density(spark, sf_dir):
    od = pixels.rgb_to_sda(_rgb(spark, sf_dir))
    back = pixels.sda_to_rgb(od).select("vec_id", "y", "x", *(F.round(c, 6).alias(f"back_{c}") for c in "rgb"))
    return od.select("vec_id", "y", "x", *(F.round(c, 9).alias(c) for c in "rgb")).join(back, ["vec_id", "y", "x"])


# Stains at right angles, whose inverse is their transpose: (0.6, 0.8, 0), (-0.8, 0.6, 0), (0, 0, 1).
_STAINS = [[0.6, 0.8, 0.0], [-0.8, 0.6, 0.0]]


@query(f"WITH {_RGB} SELECT vec_id, y, x, round(0.6 * r + 0.8 * g, 6) AS s0, round(-0.8 * r + 0.6 * g, 6) AS s1, round(b, 6) AS s2, round(r, 6) AS r, round(g, 6) AS g, round(b, 6) AS b FROM rgb", "pixels")
def X4_stain_separation(spark, sf_dir):
    parts = pixels.color_deconvolution(_rgb(spark, sf_dir), _STAINS)
    return pixels.color_convolution(parts, _STAINS).select("vec_id", "y", "x", *(F.round(c, 6).alias(c) for c in ("s0", "s1", "s2", "r", "g", "b")))


@query("SELECT vec_id, y, x, round((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 6) AS v FROM pixels WINDOW w AS (PARTITION BY vec_id)", "pixels")
def X5_normalize_pixels(spark, sf_dir):
    return pixels.normalize_pixels(_pixels(spark, sf_dir), "vec_id").select("vec_id", "y", "x", F.round("v", 6).alias("v"))


@query("SELECT vec_id, y, x, round((v - min(v) OVER w) / nullif(max(v) OVER w - min(v) OVER w, 0), 9) AS v FROM pixels WINDOW w AS (PARTITION BY vec_id)", "pixels")
def X6_rescale_intensity(spark, sf_dir):
    return pixels.rescale_intensity(_pixels(spark, sf_dir), "vec_id").select("vec_id", "y", "x", F.round("v", 9).alias("v"))


_LEVEL = "lv AS (SELECT vec_id, y, x, CAST(floor(64 * (v + 1) / 2) AS INT) AS level FROM pixels)"


def _levels(spark, sf_dir):
    return _pixels(spark, sf_dir).select("vec_id", "y", "x", F.floor(64 * (F.col("v") + 1) / 2).cast("int").alias("level"))


@query(f"WITH {_LEVEL} SELECT a.vec_id, a.y, a.x, round(count(*) / 64, 9) AS cdf FROM lv a JOIN lv b ON a.vec_id = b.vec_id AND b.level <= a.level GROUP BY a.vec_id, a.y, a.x", "pixels")
def W6_equalize(spark, sf_dir):
    return pixels.equalize(_levels(spark, sf_dir), "vec_id").select("vec_id", "y", "x", F.round("cdf", 9).alias("cdf"))


@query(
    f"""WITH {_LEVEL}, t AS (SELECT DISTINCT vec_id, level FROM lv), s AS (SELECT t.vec_id, t.level, count(*) FILTER (lv.level < t.level) AS w0, count(*) FILTER (lv.level >= t.level) AS w1, avg(lv.level) FILTER (lv.level < t.level) AS m0, avg(lv.level) FILTER (lv.level >= t.level) AS m1
        FROM t JOIN lv USING (vec_id) GROUP BY ALL)
      SELECT vec_id, arg_min(level, {{'a': -round(w0 * w1 * (m0 - m1) ** 2, 6), 'l': level}}) AS threshold FROM s WHERE w0 > 0 GROUP BY vec_id""",
    "pixels",
)
def W5_otsu(spark, sf_dir):
    return pixels.otsu(pixels.histogram(_levels(spark, sf_dir), ["vec_id"]), ["vec_id"])


@query(f"WITH {_LEVEL}, n AS (SELECT vec_id, level, count(*) / 64 AS p FROM lv GROUP BY ALL) SELECT vec_id, round(-sum(p * log2(p)), 6) AS entropy FROM n GROUP BY vec_id", "pixels")
def X7_entropy(spark, sf_dir):
    return pixels.entropy(pixels.histogram(_levels(spark, sf_dir), ["vec_id"]), ["vec_id"]).withColumn("entropy", F.round("entropy", 6))


# Thresholds of the entropies `en` (image, gr, gc, channel, level) by image and channel, and the blocks at or over one of them.
_OVER = """lev AS (SELECT DISTINCT image, channel, level FROM en), side AS (SELECT lev.image, lev.channel, lev.level, count(*) FILTER (en.level < lev.level) AS w0, count(*) FILTER (en.level >= lev.level) AS w1,
    avg(en.level) FILTER (en.level < lev.level) AS m0, avg(en.level) FILTER (en.level >= lev.level) AS m1 FROM lev JOIN en USING (image, channel) GROUP BY ALL),
  thr AS (SELECT image, channel, arg_min(level, {'a': -round(w0 * w1 * (m0 - m1) ** 2, 6), 'l': level}) AS threshold FROM side WHERE w0 > 0 GROUP BY ALL),
  tis AS (SELECT DISTINCT image, gr, gc FROM en JOIN thr USING (image, channel) WHERE level >= threshold)"""
_AT = "vec_id // 100 AS image, CAST(vec_id // 10 % 10 AS INT) AS gr, CAST(vec_id % 10 AS INT) AS gc"


@query(
    f"""WITH {_LEVEL}, p AS (SELECT vec_id, level // 8 AS l, count(*) / 64 AS p FROM lv GROUP BY ALL), en AS (SELECT {_AT}, 0 AS channel, floor(-sum(p * log2(p)) * 32) AS level FROM p GROUP BY vec_id), {_OVER}
      SELECT image, gr, gc FROM tis""",
    "pixels",
)
def X7_tissue_blocks(spark, sf_dir):
    """Vectors as blocks of images of a hundred."""
    blocks = pixels.histogram(_levels(spark, sf_dir).withColumn("level", F.expr("level div 8")), ["vec_id"])
    own = blocks.select(F.expr("vec_id div 100").alias("image"), F.expr("vec_id div 10 % 10").cast("int").alias("gr"), (F.col("vec_id") % 10).cast("int").alias("gc"), F.lit(0).alias("channel"), "level", "n")
    return pixels.tissue_blocks(own, "image")


@query(
    f"""WITH RECURSIVE ch AS (SELECT vec_id, c, CAST(floor((v + 1) * f) AS INT) AS l FROM pixels, (VALUES ('r', 4), ('g', 3), ('b', 5)) AS k(c, f)), p AS (SELECT vec_id, c, l, count(*) / 64 AS p FROM ch GROUP BY ALL),
      en AS (SELECT {_AT}, c AS channel, floor(-sum(p * log2(p)) * 32) AS level FROM p GROUP BY vec_id, c), {_OVER}, near(dr, dc) AS (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)),
      bg AS (SELECT image, CAST(r AS INT) AS gr, CAST(c AS INT) AS gc FROM (SELECT DISTINCT image FROM en), range(10) AS a(r), range(10) AS b(c) WHERE (image, r, c) NOT IN (SELECT (image, gr, gc) FROM tis)),
      way_out AS (SELECT * FROM bg WHERE gr IN (0, 9) OR gc IN (0, 9) UNION SELECT bg.image, bg.gr, bg.gc FROM way_out o JOIN near ON true JOIN bg ON bg.image = o.image AND bg.gr = o.gr + dr AND bg.gc = o.gc + dc),
      filled AS (SELECT * FROM tis UNION ALL SELECT * FROM bg WHERE (image, gr, gc) NOT IN (SELECT (image, gr, gc) FROM way_out)),
      part USING KEY (image, gr, gc) AS (SELECT image, gr, gc, gr * 10 + gc AS root FROM filled
        UNION SELECT f.image, f.gr, f.gc, min(p.root) AS root FROM part p JOIN near ON true JOIN recurring.part f ON f.image = p.image AND f.gr = p.gr + dr AND f.gc = p.gc + dc WHERE p.root < f.root GROUP BY f.image, f.gr, f.gc),
      big AS (SELECT image, root FROM part GROUP BY ALL HAVING count(*) >= 4)
      SELECT image, gr, gc, CAST(dense_rank() OVER (PARTITION BY image ORDER BY root) AS INT) AS component FROM part SEMI JOIN big USING (image, root)""",
    "pixels",
)
def X7_tissue_from_pixels(spark, sf_dir):
    """A hundred vectors as the blocks of an image of 80 x 80 pixels in three channels; parts of fewer than four blocks go."""
    on_workers(spark)
    level = lambda f: F.floor((F.col("v") + 1) * f).cast("int")
    rows = _pixels(spark, sf_dir).select(F.expr("vec_id div 100").alias("image"), (F.expr("vec_id div 10 % 10") * 8 + F.col("y")).alias("y"), (F.col("vec_id") % 10 * 8 + F.col("x")).alias("x"), level(4).alias("r"), level(3).alias("g"), level(5).alias("b"))
    sizes = rows.select("image").distinct().withColumns({"gh": F.lit(10), "gw": F.lit(10)})
    return pixels.tissue_from_pixels(rows, "image", sizes, block=8, least_share=0.04)


@query("SELECT vec_id, y, x, round(CASE WHEN v * 100 <= 39.5 - 59 / 2.0E0 THEN 0 WHEN v * 100 > 39.5 + 59 / 2.0E0 THEN 255 ELSE ((v * 100 - 39.5) / 59 + 0.5) * 255 END, 6) AS shown FROM pixels", "pixels")
def X8_window_center(spark, sf_dir):
    return _pixels(spark, sf_dir).select("vec_id", "y", "x", F.round(pixels.window_center(F.col("v") * 100, 40, 60), 6).alias("shown"))


@query("SELECT vec_id, y, x, CAST(round_even(greatest(0, least(1, v)) * 255, 0) AS INT) AS byte, round(round_even(greatest(0, least(1, v)) * 255, 0) / 255, 9) AS unit, v >= 0.5 AS on_ FROM pixels", "pixels")
def X9_convert_pixels(spark, sf_dir):
    byte = pixels.convert_pixels(F.col("v"), "float", "byte")
    return _pixels(spark, sf_dir).select("vec_id", "y", "x", byte.alias("byte"), F.round(pixels.convert_pixels(byte, "byte", "float"), 9).alias("unit"), pixels.convert_pixels(F.col("v"), "float", "bool").alias("on_"))


@query(
    """WITH cut AS (SELECT d.slide_id, label, CAST(greatest(0, least(round_even(x0, 0), w)) AS INT) AS x0, CAST(greatest(0, least(round_even(y0, 0), h)) AS INT) AS y0, CAST(greatest(0, least(round_even(x1, 0), w)) AS INT) AS x1, CAST(greatest(0, least(round_even(y1, 0), h)) AS INT) AS y1
        FROM detections d JOIN slides USING (slide_id) WHERE label = 3 AND score > 0.9),
      px AS (SELECT slide_id, label, x0, y0, x1, y1, y, unnest(range(x0, x1)) AS x FROM (SELECT *, unnest(range(y0, y1)) AS y FROM cut))
      SELECT slide_id, CAST(y AS INT) AS y, CAST(x AS INT) AS x, max(label) AS label FROM px WHERE y < y0 + 3 OR y >= y1 - 3 OR x < x0 + 3 OR x >= x1 - 3 GROUP BY ALL""",
    "detections", "slides",
)
def G12_outline_pixels(spark, sf_dir):
    on_workers(spark)
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    return pixels.outline_pixels(boxes.clip_boxes(dets.filter("label = 3 and score > 0.9"), slides))


@query(None)
def G12_outline_pixels_all(spark, sf_dir):
    """All clipped detections of a class, as boxes of several labels overlap; the one above has the SQL for one label."""
    on_workers(spark)
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    return pixels.outline_pixels(boxes.clip_boxes(dets.filter("label > 0"), slides))


_BOXES = """cut AS (SELECT d.slide_id, label, CAST(greatest(0, least(round_even(x0, 0), w)) AS INT) AS x0, CAST(greatest(0, least(round_even(y0, 0), h)) AS INT) AS y0, CAST(greatest(0, least(round_even(x1, 0), w)) AS INT) AS x1, CAST(greatest(0, least(round_even(y1, 0), h)) AS INT) AS y1
    FROM detections d JOIN slides USING (slide_id) WHERE label > 0 {}), box AS (SELECT *, unnest(range(y0, y1)) AS y FROM cut WHERE x0 < x1 AND y0 < y1),
  line AS (SELECT slide_id, label, y, x0, x1 - 1 AS x1 FROM box WHERE y < y0 + 3 OR y >= y1 - 3 OR x1 - x0 <= 6
    UNION ALL SELECT slide_id, label, y, x0, x0 + 2 FROM box WHERE y >= y0 + 3 AND y < y1 - 3 AND x1 - x0 > 6 UNION ALL SELECT slide_id, label, y, x1 - 3, x1 - 1 FROM box WHERE y >= y0 + 3 AND y < y1 - 3 AND x1 - x0 > 6)"""
# A sweep over the run ends of each row of `line`.
_SWEEP = """ev AS (SELECT slide_id, y, x0 AS x, label AS l, x1 AS t FROM line UNION ALL SELECT slide_id, y, x1 + 1, NULL, NULL FROM line),
  pl AS (SELECT slide_id, y, x, max(t) FILTER (l = 1) AS t1, max(t) FILTER (l = 2) AS t2, max(t) FILTER (l = 3) AS t3, max(t) FILTER (l = 4) AS t4 FROM ev GROUP BY ALL),
  nw AS (SELECT slide_id, y, x, CASE WHEN max(t4) OVER w >= x THEN 4 WHEN max(t3) OVER w >= x THEN 3 WHEN max(t2) OVER w >= x THEN 2 WHEN max(t1) OVER w >= x THEN 1 END AS label FROM pl WINDOW w AS (PARTITION BY slide_id, y ORDER BY x)),
  ch AS (SELECT * FROM nw QUALIFY label IS DISTINCT FROM lag(label) OVER (PARTITION BY slide_id, y ORDER BY x)),
  fin AS (SELECT slide_id, y, label, x AS x0, lead(x) OVER (PARTITION BY slide_id, y ORDER BY x) - 1 AS x1 FROM ch)
  SELECT slide_id, CAST(y AS INT) AS y, label, count(*) AS n_runs, CAST(sum(x1 - x0 + 1) AS BIGINT) AS n_pixels, CAST(sum(x0) AS BIGINT) AS starts FROM fin WHERE label IS NOT NULL GROUP BY ALL"""


def _by_row(runs):
    return runs.groupBy("slide_id", "y", "label").agg(F.count("*").alias("n_runs"), F.sum(F.col("x1") - F.col("x0") + 1).alias("n_pixels"), F.sum("x0").alias("starts"))


@query(f"WITH {_BOXES.format('')}, {_SWEEP}", "detections", "slides")
def G12_label_runs(spark, sf_dir):
    """The label image of all outlines as runs, summed by row and label."""
    on_workers(spark)
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    return _by_row(raster.draw_detections(dets, slides))


@query(
    f"""WITH {_BOXES.format('AND label <> 2').replace('line AS', 'outline AS')}, {_FILL},
      line AS (SELECT * FROM outline UNION ALL SELECT p.slide_id, label, y, greatest(x0, 0), least(x1, w - 1) FROM drawn p JOIN slides USING (slide_id) WHERE label = 2 AND y >= 0 AND y < h AND x1 >= 0 AND x0 < w), {_SWEEP}""",
    "detections", "slides",
)
def G12_draw_detections(spark, sf_dir):
    """Class 2 as filled polygons, the others as outlines, in one label image."""
    on_workers(spark)
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    own = dets.withColumn("vertices", F.when(F.col("label") == 2, _hexagons(dets)))
    moved = F.transform("vertices", lambda p: F.struct((p["x"] - F.rint("x0")).alias("x"), (p["y"] - F.rint("y0")).alias("y")))
    return _by_row(raster.draw_detections(own.withColumn("mask_poly", moved).drop("vertices"), slides))


@query(
    f"""WITH hexa AS (SELECT slide_id, nucleus_id, label, {_HEX} AS v FROM detections)
      SELECT slide_id AS image_id, nucleus_id % 100000 AS id, label, len(v) AS n, round(list_sum(list_transform(v, lambda p: p.x)), 6) AS x_sum, round(list_sum(list_transform(v, lambda p: p.y)), 6) AS y_sum,
        round(abs(list_sum(list_transform(list_zip(v, list_concat(v[2:], v[1:1])), lambda s: s[1].x * s[2].y - s[2].x * s[1].y))) / 2, 6) AS area FROM hexa""",
    "detections",
)
def S12_polygon_rows(spark, sf_dir):
    """Polygons as annotation rows in JSON, and back."""
    (dets,) = tables(spark, sf_dir, "detections")
    rows = dets.select((F.col("slide_id") * 100_000 + F.col("nucleus_id")).alias("id"), F.col("slide_id").alias("image_id"), "label", _hexagons(dets).alias("vertices"))
    back = masks.from_coco_polygons(masks.to_coco_polygons(rows))
    total = lambda c: F.round(F.aggregate("vertices", F.lit(0.0), lambda s, p: s + p[c]), 6)
    return back.select("image_id", (F.col("id") % 100_000).alias("id"), "label", F.size("vertices").alias("n"), total("x").alias("x_sum"), total("y").alias("y_sum"), F.round(polygon_area(F.col("vertices")), 6).alias("area"))
