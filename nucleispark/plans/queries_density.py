"""Queries on densities, regions, patches, edges and the feature summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from nucleispark.operators import boxes, density, features, graph, roi, summary, tiles
from nucleispark.plans.fixtures import tables
from nucleispark.plans.registry import query
from nucleispark.session import on_workers

_CELLS = """cells AS (SELECT slide_id, label - 1 AS cls, CAST(round_even((y0 + y1) / 2, 0) AS INT) AS row, CAST(round_even((x0 + x1) / 2, 0) AS INT) AS col, CAST(count(*) AS DOUBLE) AS val
  FROM detections WHERE label BETWEEN 1 AND 3 GROUP BY ALL)"""
_POOL = f"{_CELLS}, pool AS (SELECT slide_id, cls, row // 32 AS gr, col // 32 AS gc, sum(val) / 1024 AS d FROM cells GROUP BY ALL)"


def _cells(spark, sf_dir):
    return density.nuclei_map(boxes.filter_labels(*tables(spark, sf_dir, "detections"), 3))


def _pooled(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    return density.pool_density(_cells(spark, sf_dir), slides, 32)


@query(f"WITH {_CELLS} SELECT * FROM cells", "detections")
def A4_nuclei_map(spark, sf_dir):
    return _cells(spark, sf_dir)


@query(f"WITH {_POOL} SELECT slide_id, cls, gr, gc, round(d, 9) AS d FROM pool JOIN (SELECT slide_id FROM slides) USING (slide_id) WHERE gr < 128 AND gc < 128", "detections", "slides")
def A6_pool_density(spark, sf_dir):
    return _pooled(spark, sf_dir).withColumn("d", F.round("d", 9))


@query(
    f"""WITH {_CELLS}, b AS (SELECT CAST(i AS INT) AS i, CAST(floor(i * 4096 / 85) AS INT) AS a, CAST(ceil((i + 1) * 4096 / 85) AS INT) AS e FROM range(85) AS r(i))
      SELECT slide_id, cls, x.i AS gr, y.i AS gc, round(sum(val / ((x.e - x.a) * (y.e - y.a))), 9) AS d FROM cells JOIN slides USING (slide_id) JOIN b x ON row >= x.a AND row < x.e JOIN b y ON col >= y.a AND col < y.e GROUP BY ALL""",
    "detections", "slides",
)
def A6_pool_overlapping_bins(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    return density.pool_density(_cells(spark, sf_dir), slides, 48).withColumn("d", F.round("d", 9))


_DOTS = f"""{_POOL}, pairs(i, j) AS (VALUES (0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)),
  dots AS (SELECT s.slide_id, i, j, coalesce(sum(a.d * b.d), 0) AS dot FROM (SELECT DISTINCT slide_id FROM pool) s, pairs LEFT JOIN pool a ON a.slide_id = s.slide_id AND a.cls = i
    LEFT JOIN pool b ON b.slide_id = a.slide_id AND b.cls = j AND b.gr = a.gr AND b.gc = a.gc GROUP BY ALL)"""


@query(f"WITH {_DOTS} SELECT slide_id, i, j, round(dot, 9) AS dot FROM dots", "detections")
def J3_dot_products(spark, sf_dir):
    return density.dot_products(_pooled(spark, sf_dir), 3).withColumn("dot", F.round("dot", 9))


_RATIOS = f"""{_DOTS}, o AS (SELECT slide_id, i, j, dot FROM dots WHERE i < j UNION ALL SELECT slide_id, j, i, dot FROM dots WHERE i < j), s AS (SELECT slide_id, i AS k, dot AS self FROM dots WHERE i = j),
  p AS (SELECT o.*, dot / nullif(self, 0) AS p FROM o JOIN s ON s.slide_id = o.slide_id AND s.k = o.j),
  ratios AS (
    SELECT slide_id, k || '.norm' AS name, sqrt(self) AS value FROM s UNION ALL SELECT slide_id, k || '.norm.logit', CASE WHEN self > 0 THEN ln(sqrt(self)) END FROM s
    UNION ALL SELECT slide_id, i || '_' || j || '.proj', p FROM p UNION ALL SELECT slide_id, i || '_' || j || '.proj.logit', CASE WHEN p > 0 THEN ln(p) END FROM p
    UNION ALL SELECT slide_id, i || '_' || j || '.proj.prob', CASE WHEN p > 0 THEN 1 / (1 + exp(-ln(p))) END FROM p
    UNION ALL SELECT d.slide_id, i || '_' || j || '.cos', dot / nullif(sqrt(a.self), 0) / nullif(sqrt(b.self), 0) FROM dots d JOIN s a ON a.slide_id = d.slide_id AND a.k = i JOIN s b ON b.slide_id = d.slide_id AND b.k = j WHERE i < j)"""


@query(f"WITH {_RATIOS} SELECT slide_id, name, round(value, 6) AS value FROM ratios", "detections")
def A11_density_ratios(spark, sf_dir):
    return features.density_ratios(density.dot_products(_pooled(spark, sf_dir), 3)).withColumn("value", F.round("value", 6))


@query(
    f"""WITH {_DOTS}, n AS (SELECT slide_id, cls, sum(val) AS nuclei, sum(d) AS mass FROM (SELECT slide_id, cls, val, val / 1024 AS d FROM cells) GROUP BY ALL)
      SELECT slide_id, i, j, round(dot, 9) AS dot, round(dot / nullif(sqrt((SELECT dot FROM dots x WHERE x.slide_id = dots.slide_id AND x.i = dots.i AND x.j = dots.i)), 0)
        / nullif(sqrt((SELECT dot FROM dots x WHERE x.slide_id = dots.slide_id AND x.i = dots.j AND x.j = dots.j)), 0), 6) AS cosine FROM dots""",
    "detections",
)
def D6_class_density_cosine(spark, sf_dir):
    """Class densities at 1/32, their products and cosines for each slide."""
    dots = density.dot_products(_pooled(spark, sf_dir), 3)
    own = dots.filter("i = j").select("slide_id", F.col("i").alias("k"), F.sqrt("dot").alias("norm"))
    both = dots.join(own.select("slide_id", F.col("k").alias("i"), F.col("norm").alias("a")), ["slide_id", "i"]).join(own.select("slide_id", F.col("k").alias("j"), F.col("norm").alias("b")), ["slide_id", "j"])
    cosine = F.col("dot") / F.nullif(F.col("a"), F.lit(0.0)) / F.nullif(F.col("b"), F.lit(0.0))
    return both.select("slide_id", "i", "j", F.round("dot", 9).alias("dot"), F.round(cosine, 6).alias("cosine"))


_TAPS = "taps(dr, dc, weight) AS (VALUES (0, 0, 1.0E0), (0, 1, 0.5E0), (1, 0, 0.25E0), (-1, -1, 0.125E0))"


@query(
    f"""WITH {_POOL}, {_TAPS} SELECT slide_id, cls, gr - dr AS gr, gc - dc AS gc, round(sum(d * weight), 9) AS d FROM pool, taps WHERE gr - dr BETWEEN 0 AND 127 AND gc - dc BETWEEN 0 AND 127 GROUP BY ALL""",
    "detections",
)
def D2_smooth_by_taps(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    taps = spark.createDataFrame([(c, *t) for c in range(3) for t in ((0, 0, 1.0), (0, 1, 0.5), (1, 0, 0.25), (-1, -1, 0.125))], "cls int, dr int, dc int, weight double")
    return density.smooth_by_taps(_pooled(spark, sf_dir), taps, density.pooled_sizes(slides, 32)).withColumn("d", F.round("d", 9))


# Kernels from their definition: a disk of half the reach, blurred by a Gaussian with mirrored ends, inside the disk of the reach.
_KERNELS = """rad AS (SELECT slide_id, CAST(label - 1 AS INT) AS cls, quantile_disc(sqrt((x1 - x0) * (y1 - y0)), 0.5) / 2 AS radius FROM detections WHERE label BETWEEN 1 AND 3 GROUP BY ALL),
  own AS (SELECT *, CAST(round_even(radius / 4, 0) AS INT) AS a, CAST(round_even(radius / 2, 0) AS INT) AS b FROM rad WHERE radius > 1), ker AS (SELECT DISTINCT a, b, 2 * b + 1 AS n FROM own),
  tap AS (SELECT a, b, n, t, e / sum(e) OVER (PARTITION BY a, b) AS w FROM (SELECT *, CASE WHEN a = 0 THEN 1 ELSE exp(-0.5 * (t / (a / 2)) ** 2) END AS e FROM (SELECT *, unnest(range(-2 * a, 2 * a + 1)) AS t FROM ker))),
  line AS (SELECT a, b, i, least(s, 2 * n - 1 - s) AS j, sum(w) AS w FROM (SELECT *, (i + t + 2 * n) % (2 * n) AS s FROM (SELECT *, unnest(range(n)) AS i FROM tap)) GROUP BY ALL),
  kern AS (SELECT x.a, x.b, CAST(x.i - x.b AS INT) AS dr, CAST(y.i - y.b AS INT) AS dc, sum(x.w * y.w) AS weight FROM line x JOIN line y ON x.a = y.a AND x.b = y.b AND (x.j - x.b) ** 2 + (y.j - y.b) ** 2 <= x.a ** 2
    WHERE (x.i - x.b) ** 2 + (y.i - y.b) ** 2 <= x.b ** 2 GROUP BY ALL)"""


@query(f"WITH {_KERNELS} SELECT slide_id, cls, dr, dc, round(weight, 9) AS weight FROM own JOIN kern USING (a, b) WHERE weight <> 0", "detections")
def D1_density_kernels(spark, sf_dir):
    on_workers(spark)
    (dets,) = tables(spark, sf_dir, "detections")
    return density.class_kernels(features.class_radius(boxes.filter_labels(dets, 3), 3), 1 / 32).withColumn("weight", F.round("weight", 9))


@query(
    f"""WITH {_POOL}, {_KERNELS} SELECT p.slide_id, p.cls, CAST(gr - dr AS INT) AS gr, CAST(gc - dc AS INT) AS gc, round(sum(d * weight), 9) AS d FROM pool p JOIN own USING (slide_id, cls) JOIN kern USING (a, b)
      WHERE gr - dr BETWEEN 0 AND 127 AND gc - dc BETWEEN 0 AND 127 GROUP BY ALL HAVING sum(d * weight) <> 0
      UNION ALL SELECT slide_id, cls, CAST(gr AS INT), CAST(gc AS INT), round(d, 9) FROM pool ANTI JOIN own USING (slide_id, cls)""",
    "detections",
)
def D2_smooth_density(spark, sf_dir):
    on_workers(spark)
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    radius = features.class_radius(boxes.filter_labels(dets, 3), 3)
    return density.smooth_density(_pooled(spark, sf_dir), radius, density.pooled_sizes(slides, 32), 1 / 32).withColumn("d", F.round("d", 9))


@query(f"WITH {_CELLS} SELECT slide_id, row // 64 AS gr, col // 64 AS gc, CAST(bool_or(cls = 1) AS INT) AS r, CAST(bool_or(cls = 0) AS INT) AS g, CAST(bool_or(cls = 2) AS INT) AS b FROM cells GROUP BY ALL", "detections")
def G13_scatter_cells(spark, sf_dir):
    colors = spark.createDataFrame([(0, 0, 255, 0), (1, 255, 0, 0), (2, 0, 0, 255)], "cls int, r int, g int, b int")
    return density.scatter_cells(_cells(spark, sf_dir), colors, 64)


@query(
    f"""WITH {_POOL} SELECT slide_id, gr, gc, round(least(1, coalesce(sum(d) FILTER (cls = 1), 0) * 96), 9) AS r, round(least(1, coalesce(sum(d) FILTER (cls = 0), 0) * 96), 9) AS g,
      round(least(1, coalesce(sum(d) FILTER (cls = 2), 0) * 96), 9) AS b FROM pool GROUP BY ALL""",
    "detections",
)
def G14_density_image(spark, sf_dir):
    return density.density_image(_pooled(spark, sf_dir), 32).select("slide_id", "gr", "gc", *(F.round(c, 9).alias(c) for c in "rgb"))


_PATCH = "patch AS (SELECT slide_id, CAST(r * 100000 + c AS INT) AS patch_id, c * 512 AS x, r * 512 AS y FROM slides, range(8) AS a(c), range(8) AS b(r))"
_IN = f"{_CELLS}, {_PATCH}, inside AS (SELECT c.*, patch_id FROM cells c JOIN patch p ON c.slide_id = p.slide_id AND row >= y AND row < y + 512 AND col >= x AND col < x + 512)"


def _patches(spark, sf_dir, size: int = 512):
    (slides,) = tables(spark, sf_dir, "slides")
    return tiles.tile_grid(slides.select("slide_id", "h", "w"), size).withColumn("patch_id", F.col("tile_row") * 100_000 + F.col("tile_col"))


@query(f"WITH {_IN} SELECT slide_id, patch_id, cls, row, col FROM inside", "detections", "slides")
def J1_points_in_patches(spark, sf_dir):
    return graph.points_in_patches(_cells(spark, sf_dir), _patches(spark, sf_dir), 300).select("slide_id", "patch_id", "cls", "row", "col")


_SCORED = f"{_IN}, scored AS (SELECT p.slide_id, p.patch_id, count(i.cls) AS n_points, count(i.cls) FILTER (i.cls = 0) AS n_core FROM patch p LEFT JOIN inside i ON p.slide_id = i.slide_id AND p.patch_id = i.patch_id GROUP BY ALL)"


@query(f"WITH {_SCORED} SELECT * FROM scored", "detections", "slides")
def G9_score_patches(spark, sf_dir):
    return graph.score_patches(_patches(spark, sf_dir), _cells(spark, sf_dir), 512).select("slide_id", "patch_id", "n_points", "n_core")


@query(
    f"""WITH {_CELLS}, mask AS (SELECT slide_id, row, col FROM cells WHERE cls = 1), grid AS (SELECT slide_id, CAST(r * 100000 + c AS INT) AS patch_id, c, r FROM slides, range(8) AS a(c), range(8) AS b(r)),
      n AS (SELECT slide_id, CAST(row // 512 * 100000 + col // 512 AS INT) AS patch_id, count(*) AS n FROM mask GROUP BY ALL)
      SELECT slide_id, patch_id, round(coalesce(n, 0) / (512 * 512), 12) AS coverage FROM grid LEFT JOIN n USING (slide_id, patch_id)""",
    "detections", "slides",
)
def G9_patch_coverage(spark, sf_dir):
    mask = _cells(spark, sf_dir).filter("cls = 1").select("slide_id", "row", "col")
    return graph.patch_coverage(_patches(spark, sf_dir), mask, 512).select("slide_id", "patch_id", F.round("coverage", 12).alias("coverage"))


@query(f"WITH {_SCORED} SELECT *, CAST(row_number() OVER (PARTITION BY slide_id ORDER BY n_core DESC, patch_id) AS INT) AS rank FROM scored QUALIFY rank <= 12", "detections", "slides")
def W2_best_patches(spark, sf_dir):
    return graph.best_patches(graph.score_patches(_patches(spark, sf_dir), _cells(spark, sf_dir), 512), 12).select("slide_id", "patch_id", "n_points", "n_core", "rank")


@query(f"WITH {_SCORED} SELECT *, CAST(row_number() OVER (PARTITION BY slide_id ORDER BY n_points - 2 * n_core DESC, patch_id) AS INT) AS rank FROM scored QUALIFY rank <= 12", "detections", "slides")
def F2_patches_by_own_score(spark, sf_dir):
    """The caller's score: points of other classes less those of the core."""
    scored = graph.score_patches(_patches(spark, sf_dir), _cells(spark, sf_dir), 512)
    return graph.best_patches(scored, 12, F.col("n_points") - 2 * F.col("n_core")).select("slide_id", "patch_id", "n_points", "n_core", "rank")


_CHOSEN = f"""{_SCORED}, pool2 AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY n_core DESC, patch_id) AS rank FROM scored),
  chosen AS (SELECT slide_id, patch_id FROM pool2 WHERE rank <= 12 AND n_points >= 40 AND n_core >= 40 QUALIFY row_number() OVER (PARTITION BY slide_id ORDER BY rank) <= 6)"""


def _chosen(spark, sf_dir):
    return graph.choose_patches(graph.score_patches(_patches(spark, sf_dir), _cells(spark, sf_dir), 512), 6, 40)


@query(f"WITH {_CHOSEN} SELECT * FROM chosen", "detections", "slides")
def K2_choose_patches(spark, sf_dir):
    return _chosen(spark, sf_dir).select("slide_id", "patch_id")


_COUNTS = f"""{_CHOSEN}, counts AS (SELECT s.slide_id, CAST(k AS INT) AS cls, count(i.patch_id) AS n FROM (SELECT DISTINCT slide_id FROM cells) s JOIN range(3) AS r(k) ON true
  LEFT JOIN (SELECT * FROM inside SEMI JOIN chosen USING (slide_id, patch_id)) i ON i.slide_id = s.slide_id AND i.cls = k GROUP BY ALL)"""


@query(f"WITH {_COUNTS} SELECT slide_id, cls, n, round(n / nullif(sum(n) OVER (PARTITION BY slide_id), 0), 9) AS prob FROM counts", "detections", "slides")
def A7_patch_counts(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    points = graph.points_in_patches(cells, _chosen(spark, sf_dir), 512)
    counts = graph.patch_counts(points, cells, 3)
    share = features.count_ratios(counts).select("slide_id", F.substring_index("name", ".", 1).cast("int").alias("cls"), F.round("value", 9).alias("prob"))
    return counts.join(share, ["slide_id", "cls"])


# Delaunay by its definition: three points whose circle holds no other. Patches of 128 pixels have few points.
_TRI = f"""{_CELLS}, pt AS (SELECT slide_id, row // 128 * 100000 + col // 128 AS patch_id, row AS y, col AS x, min(cls) AS cls FROM cells WHERE row < 4096 AND col < 4096 GROUP BY ALL),
  ids AS (SELECT *, row_number() OVER (PARTITION BY slide_id, patch_id ORDER BY y, x) AS k FROM pt),
  t AS (SELECT a.slide_id, a.patch_id, a.k AS ka, b.k AS kb, c.k AS kc, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, c.x AS cx, c.y AS cy, a.cls AS ca, b.cls AS cb, c.cls AS cc,
      (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) AS turn
    FROM ids a JOIN ids b ON a.slide_id = b.slide_id AND a.patch_id = b.patch_id AND a.k < b.k JOIN ids c ON c.slide_id = b.slide_id AND c.patch_id = b.patch_id AND b.k < c.k),
  det AS (SELECT t.*, p.k, p.x AS px, p.y AS py, sign(turn) * (
      CAST(ax - p.x AS BIGINT) * ((by_ - p.y) * (CAST((cx - p.x) AS BIGINT) ** 2 + CAST((cy - p.y) AS BIGINT) ** 2) - (cy - p.y) * (CAST((bx - p.x) AS BIGINT) ** 2 + CAST((by_ - p.y) AS BIGINT) ** 2))
    - CAST(ay - p.y AS BIGINT) * ((bx - p.x) * (CAST((cx - p.x) AS BIGINT) ** 2 + CAST((cy - p.y) AS BIGINT) ** 2) - (cx - p.x) * (CAST((bx - p.x) AS BIGINT) ** 2 + CAST((by_ - p.y) AS BIGINT) ** 2))
    + (CAST((ax - p.x) AS BIGINT) ** 2 + CAST((ay - p.y) AS BIGINT) ** 2) * ((bx - p.x) * (cy - p.y) - (cx - p.x) * (by_ - p.y))) AS det
    FROM t LEFT JOIN ids p ON p.slide_id = t.slide_id AND p.patch_id = t.patch_id AND p.k NOT IN (ka, kb, kc) WHERE turn <> 0),
  circle AS (SELECT *, CASE WHEN det <> 0 THEN det WHEN k < ka THEN -1 ELSE sign(turn) * ((bx - px) * (cy - py) - (by_ - py) * (cx - px)) END AS side FROM det),
  empty AS (SELECT slide_id, patch_id, ka, kb, kc, ax, ay, bx, by_, cx, cy, ca, cb, cc, max(side) AS worst FROM circle GROUP BY ALL HAVING coalesce(max(side), -1) <= 0),
  side AS (SELECT slide_id, patch_id, least(ca, cb) AS i, greatest(ca, cb) AS j, sqrt((ax - bx) ** 2 + (ay - by_) ** 2) AS dist FROM empty
    UNION ALL SELECT slide_id, patch_id, least(cb, cc), greatest(cb, cc), sqrt((bx - cx) ** 2 + (by_ - cy) ** 2) FROM empty
    UNION ALL SELECT slide_id, patch_id, least(ca, cc), greatest(ca, cc), sqrt((ax - cx) ** 2 + (ay - cy) ** 2) FROM empty),
  edges AS (SELECT * FROM side WHERE dist > 0 AND dist < 100)"""


def _edges(spark, sf_dir):
    on_workers(spark)
    cells = _cells(spark, sf_dir).filter("row < 4096 and col < 4096")
    patch = (F.floor(F.col("row") / 128) * 100_000 + F.floor(F.col("col") / 128)).alias("patch_id")
    return graph.delaunay_edges(cells.select("slide_id", patch, "cls", "row", "col"), 100.0)


@query(f"WITH {_TRI} SELECT slide_id, patch_id, i, j, count(*) AS n, round(sum(dist), 6) AS total FROM edges GROUP BY ALL", "detections")
def D3_delaunay_edges(spark, sf_dir):
    """Sides by patch and class pair."""
    return _edges(spark, sf_dir).groupBy("slide_id", "patch_id", "i", "j").agg(F.count("*").alias("n"), F.round(F.sum("dist"), 6).alias("total"))


_STATS = f"""{_TRI}, pairs(i, j) AS (VALUES (0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)),
  stats AS (SELECT s.slide_id, p.i, p.j, avg(dist) AS mean, stddev_samp(dist) AS std, count(dist) AS n FROM (SELECT DISTINCT slide_id FROM cells) s JOIN pairs p ON true LEFT JOIN edges e ON e.slide_id = s.slide_id AND e.i = p.i AND e.j = p.j GROUP BY ALL)"""


@query(f"WITH {_STATS} SELECT slide_id, i, j, round(mean, 6) AS mean, round(std, 6) AS std, n FROM stats", "detections")
def A8_edge_stats(spark, sf_dir):
    """Pairs without edges are filled in."""
    stats = graph.edge_stats(_edges(spark, sf_dir), _cells(spark, sf_dir), 3)
    return stats.select("slide_id", "i", "j", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


@query(
    f"""WITH {_STATS}, e AS (SELECT slide_id, k, sum(n) AS e FROM (SELECT slide_id, i AS k, n FROM stats UNION ALL SELECT slide_id, j, n FROM stats WHERE i < j) GROUP BY ALL),
      m AS (SELECT s.slide_id, s.i, s.j, s.n, a.e AS ei, b.e AS ej FROM stats s JOIN e a ON a.slide_id = s.slide_id AND a.k = i JOIN e b ON b.slide_id = s.slide_id AND b.k = j),
      f AS (SELECT slide_id, i || '_' || j || '.edges.marginal.prob' AS name, n / nullif(sum(n) OVER (PARTITION BY slide_id), 0) AS value FROM m
        UNION ALL SELECT slide_id, i || '_' || j || '.edges.conditional.prob', n / nullif(ej, 0) FROM m WHERE i < j UNION ALL SELECT slide_id, j || '_' || i || '.edges.conditional.prob', n / nullif(ei, 0) FROM m WHERE i < j
        UNION ALL SELECT slide_id, i || '_' || j || '.edges.dice', 2 * n / nullif(ei + ej, 0) FROM m WHERE i < j)
      SELECT slide_id, name, round(value, 9) AS value FROM f""",
    "detections",
)
def A10_edge_ratios(spark, sf_dir):
    stats = graph.edge_stats(_edges(spark, sf_dir), _cells(spark, sf_dir), 3)
    return features.edge_ratios(stats).withColumn("value", F.round("value", 9))


_ROI = f"{_POOL}, roi AS (SELECT slide_id, gr, gc FROM pool WHERE cls = 0 AND gr < 128 AND gc < 128)"
_QUADS = f"""{_ROI}, q AS (SELECT roi.slide_id, gr - dr AS qr, gc - dc AS qc, CAST(sum(b) AS INT) AS code FROM roi JOIN slides USING (slide_id), (VALUES (0, 0, 1), (0, 1, 2), (1, 0, 4), (1, 1, 8)) AS v(dr, dc, b)
  WHERE gr - dr BETWEEN 0 AND 126 AND gc - dc BETWEEN 0 AND 126 GROUP BY ALL)"""


@query(f"WITH {_QUADS} SELECT * FROM q", "detections", "slides")
def W7_quad_codes(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    return roi.quad_codes(roi.roi_cells(_pooled(spark, sf_dir)), density.pooled_sizes(slides, 32))


@query(
    f"""WITH {_QUADS} SELECT slide_id, CAST(sum(CASE WHEN code IN (6, 9) THEN 0.25 WHEN bit_count(code) = 1 THEN 0.125 WHEN bit_count(code) = 2 THEN 0.5 WHEN bit_count(code) = 3 THEN 0.875 ELSE 1 END) * 1024 AS DOUBLE) AS roi_area FROM q GROUP BY slide_id""",
    "detections", "slides",
)
def A12_quad_area(spark, sf_dir):
    """Of the unfilled mask, which SQL can check; A12_roi_area fills holes first."""
    (slides,) = tables(spark, sf_dir, "slides")
    return roi.roi_area(roi.roi_cells(_pooled(spark, sf_dir)), density.pooled_sizes(slides, 32), 32)


# Background that leads to the grid's edge, step by step; what is left is the mask with its holes filled.
_FILLED = f"""{_ROI}, near(dr, dc) AS (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)), bg AS (SELECT slide_id, CAST(r AS INT) AS gr, CAST(c AS INT) AS gc FROM slides, range(128) AS a(r), range(128) AS b(c) WHERE (slide_id, r, c) NOT IN (SELECT (slide_id, gr, gc) FROM roi)),
  way_out AS (SELECT * FROM bg WHERE gr IN (0, 127) OR gc IN (0, 127)
    UNION SELECT bg.slide_id, bg.gr, bg.gc FROM way_out o JOIN near ON true JOIN bg ON bg.slide_id = o.slide_id AND bg.gr = o.gr + dr AND bg.gc = o.gc + dc),
  filled AS (SELECT slide_id, CAST(gr AS INT) AS gr, CAST(gc AS INT) AS gc FROM roi UNION ALL SELECT * FROM bg WHERE (slide_id, gr, gc) NOT IN (SELECT (slide_id, gr, gc) FROM way_out))"""
_FILLED_QUADS = f"""{_FILLED}, q AS (SELECT slide_id, gr - dr AS qr, gc - dc AS qc, CAST(sum(b) AS INT) AS code FROM filled, (VALUES (0, 0, 1), (0, 1, 2), (1, 0, 4), (1, 1, 8)) AS v(dr, dc, b) GROUP BY ALL)"""


def _region(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    return roi.roi_cells(_pooled(on_workers(spark), sf_dir)), density.pooled_sizes(slides, 32)


@query(
    f"""WITH RECURSIVE {_FILLED_QUADS} SELECT slide_id, CAST(sum(CASE WHEN code IN (6, 9) THEN 0.25 WHEN bit_count(code) = 1 THEN 0.125 WHEN bit_count(code) = 2 THEN 0.5 WHEN bit_count(code) = 3 THEN 0.875 ELSE 1 END) * 1024 AS DOUBLE) AS roi_area
      FROM q WHERE qr BETWEEN 0 AND 126 AND qc BETWEEN 0 AND 126 GROUP BY slide_id""",
    "detections", "slides",
)
def A12_roi_area(spark, sf_dir):
    cells, sizes = _region(spark, sf_dir)
    return roi.roi_area(roi.fill_and_label(cells, sizes), sizes, 32)


@query(
    f"""WITH RECURSIVE {_FILLED}, part USING KEY (slide_id, gr, gc) AS (SELECT slide_id, gr, gc, gr * 128 + gc AS root FROM filled
        UNION SELECT f.slide_id, f.gr, f.gc, min(p.root) AS root FROM part p JOIN near ON true JOIN recurring.part f ON f.slide_id = p.slide_id AND f.gr = p.gr + dr AND f.gc = p.gc + dc WHERE p.root < f.root GROUP BY f.slide_id, f.gr, f.gc),
      big AS (SELECT slide_id, root FROM part GROUP BY ALL HAVING count(*) >= 0.0001 * 16384)
      SELECT slide_id, gr, gc, CAST(dense_rank() OVER (PARTITION BY slide_id ORDER BY root) AS INT) AS component FROM part SEMI JOIN big USING (slide_id, root)""",
    "detections", "slides",
)
def G10_fill_and_label(spark, sf_dir):
    """In blocks of 32 cells, so that a slide here has several."""
    return roi.fill_and_label(*_region(spark, sf_dir), 0.0001, 32)


_LINES = ", ".join(f"({c}, {sy}, {sx}, {ey}, {ex})" for c, sy, sx, ey, ex in (
    (1, 1, 0, 0, 1), (2, 0, 1, 1, 2), (3, 1, 0, 1, 2), (4, 2, 1, 1, 0), (5, 2, 1, 0, 1), (6, 0, 1, 1, 2), (6, 2, 1, 1, 0), (7, 2, 1, 1, 2), (8, 1, 2, 2, 1), (9, 1, 0, 0, 1), (9, 1, 2, 2, 1),
    (10, 0, 1, 2, 1), (11, 1, 0, 2, 1), (12, 1, 2, 1, 0), (13, 1, 2, 0, 1), (14, 0, 1, 1, 0),
))
_CUT = "greatest(0, least({} / 2, 127))"
_RINGS = f"""{_FILLED_QUADS}, line(code, sy, sx, ey, ex) AS (VALUES {_LINES}), piece AS (SELECT slide_id, 2 * qr + sy AS y, 2 * qc + sx AS x, 2 * qr + ey AS y2, 2 * qc + ex AS x2 FROM q JOIN line USING (code)),
  term AS (SELECT slide_id, y * 1000 + x AS here, y2 * 1000 + x2 AS after, {_CUT.format('x')} AS cx, {_CUT.format('y')} AS cy, {_CUT.format('x')} * {_CUT.format('y2')} - {_CUT.format('x2')} * {_CUT.format('y')} AS twice FROM piece),
  walk AS (SELECT slide_id, here AS start, after AS here, 1 AS n, twice, cx, cy FROM term
    UNION ALL SELECT w.slide_id, start, t.after, n + 1, w.twice + t.twice, w.cx + t.cx, w.cy + t.cy FROM walk w JOIN term t ON t.slide_id = w.slide_id AND t.here = w.here WHERE w.here > start),
  ring AS (SELECT slide_id, CAST(row_number() OVER (PARTITION BY slide_id ORDER BY start) - 1 AS INT) AS ring, n + 1 AS n_vertices, abs(twice) / 2 * 1024 AS area, cx * 32 AS x_sum, cy * 32 AS y_sum FROM walk WHERE here = start)"""


@query(f"WITH RECURSIVE {_RINGS} SELECT * FROM ring", "detections", "slides")
def G11_roi_polygons(spark, sf_dir):
    """In blocks of 32 cells, so that contours go over several; the sums are of the vertices without the last, which repeats the first."""
    cells, sizes = _region(spark, sf_dir)
    rings = roi.roi_polygons(roi.fill_and_label(cells, sizes), sizes, 32, 0.0, 32)
    total = lambda c: F.aggregate(F.slice("vertices", 2, F.size("vertices")), F.lit(0.0), lambda s, p: s + p[c])
    return rings.select("slide_id", "ring", F.size("vertices").alias("n_vertices"), "area", total("x").alias("x_sum"), total("y").alias("y_sum"))


@query(None)
def G7_sample_in_cells(spark, sf_dir):
    return roi.sample_in_cells(roi.roi_cells(_pooled(spark, sf_dir)), 100, 32)


@query(None)
def G8_random_patches(spark, sf_dir):
    on_workers(spark)
    (slides,) = tables(spark, sf_dir, "slides")
    points = roi.sample_in_cells(roi.roi_cells(_pooled(spark, sf_dir)), 100, 32)
    return roi.random_patches(points, slides, _cells(spark, sf_dir), 10, 512)


@query(None)
def D5_tme_features(spark, sf_dir):
    on_workers(spark)
    return summary.tme_features(*tables(spark, sf_dir, "detections", "slides"))[0].withColumn("value", F.round("value", 6))


@query(None)
def D6_feature_summary(spark, sf_dir):
    """The wide summary by patient."""
    on_workers(spark)
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    additive, edges = summary.tme_features(dets, slides)
    long = summary.summarize(additive, edges, boxes.filter_labels(dets, 3), patients=slides.select("slide_id", "patient_id"))
    return features.pivot_features(long, "entity", features.feature_names(3))
