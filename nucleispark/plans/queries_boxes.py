"""Queries on detections: filters, columns, exports, statistics, suppression."""

from __future__ import annotations

from pyspark.sql import functions as F

from nucleispark.functions import scalars as fn
from nucleispark.operators import boxes, features, nms
from nucleispark.plans.fixtures import tables
from nucleispark.plans.registry import query
from nucleispark.session import on_workers
from nucleispark.sources import io

_VALUES = ", ".join(f"({a}, '{b}', '{c}')" for a, b, c in io.CLASSES)
_CLASSES = f"classes(label, text, color) AS (VALUES {_VALUES})"
_SIDE = "sqrt((x1 - x0) * (y1 - y0))"


@query("SELECT slide_id, nucleus_id, label FROM detections WHERE label BETWEEN 1 AND 3", "detections")
def P1_filter_labels(spark, sf_dir):
    return boxes.filter_labels(*tables(spark, sf_dir, "detections"), 3).select("slide_id", "nucleus_id", "label")


@query("SELECT slide_id, count(*) AS n, round(sum(score), 6) AS total FROM detections WHERE score >= 0.5 GROUP BY slide_id", "detections")
def P2_filter_scores(spark, sf_dir):
    return boxes.filter_scores(*tables(spark, sf_dir, "detections"), 0.5).groupBy("slide_id").agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("total"))


@query(
    """SELECT d.slide_id, nucleus_id, x0 * mpp / 0.25 AS x0, y0 * mpp / 0.25 AS y0, x1 * mpp / 0.25 AS x1, y1 * mpp / 0.25 AS y1,
      CAST(ceil(h * mpp / 0.25) AS BIGINT) AS h, CAST(ceil(w * mpp / 0.25) AS BIGINT) AS w FROM detections d JOIN slides s USING (slide_id)""",
    "detections", "slides",
)
def P3_rescale_mpp(spark, sf_dir):
    return boxes.rescale_mpp(*tables(spark, sf_dir, "detections", "slides")).drop("label", "score")


@query(
    """SELECT slide_id, nucleus_id, (x0 + x1) / 2 AS x_c, (y0 + y1) / 2 AS y_c, round(sqrt((x1 - x0) * (y1 - y0)), 6) AS box_side,
      greatest(round_even(x1, 0) - round_even(x0, 0) + 1, 1) * greatest(round_even(y1, 0) - round_even(y0, 0) + 1, 1) AS box_area FROM detections""",
    "detections",
)
def P6_box_columns(spark, sf_dir):
    return boxes.box_columns(*tables(spark, sf_dir, "detections"), rounded=True).select("slide_id", "nucleus_id", "x_c", "y_c", F.round("box_side", 6).alias("box_side"), "box_area")


@query("SELECT slide_id, nucleus_id, (x0 + x1) / 2 AS xc, (y0 + y1) / 2 AS yc, x1 - x0 AS w, y1 - y0 AS h FROM detections", "detections")
def P7_convert_box(spark, sf_dir):
    rows = boxes.convert_box(*tables(spark, sf_dir, "detections"), "xyxy", "xywh")
    return boxes.convert_box(rows, "xywh", "cxcywh").drop("label", "score")


@query(
    """WITH cut AS (SELECT d.slide_id, nucleus_id, label,
        CAST(greatest(0, least(round_even(x0, 0), w)) AS INT) AS x0, CAST(greatest(0, least(round_even(y0, 0), h)) AS INT) AS y0,
        CAST(greatest(0, least(round_even(x1, 0), w)) AS INT) AS x1, CAST(greatest(0, least(round_even(y1, 0), h)) AS INT) AS y1
      FROM detections d JOIN slides USING (slide_id) WHERE label > 0) SELECT * FROM cut WHERE x0 < x1 AND y0 < y1""",
    "detections", "slides",
)
def P10_clip_boxes(spark, sf_dir):
    return boxes.clip_boxes(*tables(spark, sf_dir, "detections", "slides")).drop("score")


_HEX = "CAST('0x' || substr(coalesce(color, '#646464'), {}, 2) AS INT)"


@query(f"WITH {_CLASSES} SELECT slide_id, label, {_HEX.format(2)} AS r, {_HEX.format(4)} AS g, {_HEX.format(6)} AS b, count(*) AS n FROM detections LEFT JOIN classes USING (label) GROUP BY ALL", "detections")
def P11_label_color(spark, sf_dir):
    colored = boxes.label_color(*tables(spark, sf_dir, "detections"), io.class_table(spark))
    return colored.groupBy("slide_id", "label", "r", "g", "b").agg(F.count("*").alias("n"))


_TILE_OF = "CAST(least(floor((x0 + x1) / 2 / 512), 7) AS INT)"


@query(f"SELECT slide_id, '0_' || {_TILE_OF} || '_' || {_TILE_OF.replace('x0', 'y0').replace('x1', 'y1')} AS tile_key, count(*) AS n FROM detections GROUP BY ALL", "detections")
def S10_tile_keys(spark, sf_dir):
    tile = lambda a: F.least(F.floor((F.col(f"{a}0") + F.col(f"{a}1")) / 2 / 512), F.lit(7))
    (dets,) = tables(spark, sf_dir, "detections")
    return dets.groupBy("slide_id", fn.tile_key(F.lit(0), tile("x"), tile("y")).alias("tile_key")).agg(F.count("*").alias("n"))


@query(f"SELECT nucleus_id, x0, y0, x1, y1, label FROM detections WHERE slide_id = 0 AND {_TILE_OF} = 3 AND {_TILE_OF.replace('x0', 'y0').replace('x1', 'y1')} = 4", "detections")
def P12_fetch_tile(spark, sf_dir):
    tile = lambda a: F.least(F.floor((F.col(f"{a}0") + F.col(f"{a}1")) / 2 / 512), F.lit(7))
    (dets,) = tables(spark, sf_dir, "detections")
    stored = dets.withColumn("tile_key", fn.tile_key(F.lit(0), tile("x"), tile("y")))
    return boxes.fetch_tile(stored, 0, "0_3_4").select("nucleus_id", "x0", "y0", "x1", "y1", "label")


@query("SELECT slide_id, label, count(*) AS n FROM detections WHERE x1 - x0 > 2 * (y1 - y0) GROUP BY ALL", "detections")
def P13_keep_where(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    return boxes.keep_where(dets, F.col("x1") - F.col("x0") > 2 * (F.col("y1") - F.col("y0"))).groupBy("slide_id", "label").agg(F.count("*").alias("n"))


@query(
    f"""WITH {_CLASSES} SELECT slide_id, nucleus_id, CAST(round_even(x0, 0) AS INT) AS x0, CAST(round_even(y0, 0) AS INT) AS y0, CAST(round_even(x1, 0) AS INT) AS x1, CAST(round_even(y1, 0) AS INT) AS y1,
      round(score, 4) AS score, coalesce(text, 'cls_' || label) AS label FROM detections LEFT JOIN classes USING (label)""",
    "detections",
)
def S3_export_detections(spark, sf_dir):
    return io.export_detections(*tables(spark, sf_dir, "detections"), io.class_table(spark))


@query(f"WITH {_CLASSES} SELECT label, text, color, count(d.nucleus_id) AS n FROM classes LEFT JOIN detections d USING (label) GROUP BY ALL", "detections")
def S6_class_table(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    counts = dets.groupBy("label").agg(F.count("nucleus_id").alias("n"))
    return io.class_table(spark).join(counts, "label", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query(
    """SELECT slide_id, nucleus_id, x0, y0, x1, y1, (x0 + x1) / 2 AS x_c, (y0 + y1) / 2 AS y_c, label AS labels, round(score, 6) AS scores,
      greatest(round_even(x1, 0) - round_even(x0, 0) + 1, 1) * greatest(round_even(y1, 0) - round_even(y0, 0) + 1, 1) AS box_area FROM detections""",
    "detections",
)
def S7_nuclei_table(spark, sf_dir):
    return features.nuclei_table(*tables(spark, sf_dir, "detections")).withColumn("scores", F.round("scores", 6))


@query(
    """WITH n AS (SELECT slide_id, count(*) AS n FROM detections GROUP BY slide_id) SELECT DISTINCT slide_id FROM slides
      WHERE slide_id NOT IN (SELECT slide_id FROM n WHERE n * (SELECT count(*) FROM n) >= (SELECT count(*) FROM detections))""",
    "slides", "detections",
)
def S9_pending(spark, sf_dir):
    """Slides with at least the average number of nuclei are done."""
    slides, dets = tables(spark, sf_dir, "slides", "detections")
    counts = dets.groupBy("slide_id").agg(F.count("*").alias("n"))
    mean = counts.agg(F.avg("n")).first()[0] or 0
    return io.pending(slides.select("slide_id"), counts.filter(F.col("n") >= mean))


@query(
    """WITH n AS (SELECT slide_id, count(*) AS n FROM requests GROUP BY slide_id)
      SELECT DISTINCT slide_id FROM slides WHERE slide_id NOT IN (SELECT slide_id FROM n WHERE n * (SELECT count(*) FROM n) >= (SELECT count(*) FROM requests))""",
    "slides", "requests",
)
def S9_pending_all(spark, sf_dir):
    """Slides that were asked for at least as often as the average are done."""
    slides, rows = tables(spark, sf_dir, "slides", "requests")
    counts = rows.groupBy("slide_id").agg(F.count("*").alias("n"))
    mean = counts.agg(F.avg("n")).first()[0] or 0
    return io.pending(slides.select("slide_id"), counts.filter(F.col("n") >= mean))


@query(
    f"""WITH c AS (SELECT DISTINCT slide_id, cls FROM detections, range(3) AS r(cls)), m AS (
        SELECT slide_id, label - 1 AS cls, quantile_disc({_SIDE}, 0.5) / 2 AS radius FROM detections WHERE label BETWEEN 1 AND 3 GROUP BY ALL)
      SELECT slide_id, CAST(cls AS INT) AS cls, round(radius, 6) AS radius FROM c LEFT JOIN m USING (slide_id, cls)""",
    "detections",
)
def A1_class_radius(spark, sf_dir):
    return features.class_radius(*tables(spark, sf_dir, "detections"), 3).select("slide_id", "cls", F.round("radius", 6).alias("radius"))


@query("SELECT slide_id, label, count(*) AS total FROM detections GROUP BY ALL", "detections")
def A2_label_totals(spark, sf_dir):
    return features.label_totals(*tables(spark, sf_dir, "detections"))


_AREA = "greatest(round_even(x1, 0) - round_even(x0, 0) + 1, 1) * greatest(round_even(y1, 0) - round_even(y0, 0) + 1, 1)"


@query(f"SELECT slide_id, label, count(*) AS total, round(avg({_AREA}), 6) AS box_area_mean, round(stddev_samp({_AREA}), 6) AS box_area_std FROM detections GROUP BY ALL", "detections")
def A3_morphology_stats(spark, sf_dir):
    stats = features.morphology_stats(boxes.box_columns(*tables(spark, sf_dir, "detections"), rounded=True))
    return stats.select("slide_id", "label", "total", F.round("box_area_mean", 6).alias("box_area_mean"), F.round("box_area_std", 6).alias("box_area_std"))


@query(
    """WITH f AS (SELECT slide_id, label || '.total' AS name, count(*) AS v FROM detections WHERE label BETWEEN 1 AND 3 GROUP BY slide_id, label)
      SELECT CAST(patient_id AS VARCHAR) AS patient_id, name, CAST(sum(v) AS DOUBLE) AS value FROM f JOIN slides USING (slide_id) GROUP BY ALL""",
    "detections", "slides",
)
def J4_merge_by_patient(spark, sf_dir):
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    totals = features.label_totals(boxes.filter_labels(dets, 3))
    long = features.long_features(totals, "slide_id", F.col("label").cast("string"), {"total": F.col("total")})
    return features.merge_by_patient(long, slides)


@query(
    """WITH f AS (SELECT slide_id, label || '.total' AS name, count(*) AS v FROM detections WHERE label BETWEEN 1 AND 3 GROUP BY slide_id, label)
      SELECT name, patient_id, slide_id, CAST(sum(v) AS DOUBLE) AS value FROM f JOIN slides USING (slide_id) GROUP BY ROLLUP (name, patient_id, slide_id) HAVING name IS NOT NULL""",
    "detections", "slides",
)
def A13_totals_by_level(spark, sf_dir):
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    totals = features.label_totals(boxes.filter_labels(dets, 3))
    return features.totals_by_level(features.long_features(totals, "slide_id", F.col("label").cast("string"), {"total": F.col("total")}), slides)


@query(
    """SELECT slide_id, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS "tumor.total", CAST(count(*) FILTER (label = 2) AS DOUBLE) AS "stromal.total", CAST(count(*) FILTER (label = 3) AS DOUBLE) AS "sTILs.total"
      FROM detections WHERE label BETWEEN 1 AND 3 GROUP BY slide_id""",
    "detections",
)
def A19_pivot_features(spark, sf_dir):
    totals = features.label_totals(boxes.filter_labels(*tables(spark, sf_dir, "detections"), 3))
    long = features.long_features(totals, "slide_id", F.col("label").cast("string"), {"total": F.col("total")})
    named = features.rename_features(long, {"1": "tumor", "2": "stromal", "3": "sTILs"})
    return features.pivot_features(named, "slide_id", ["tumor.total", "stromal.total", "sTILs.total"])


_T = "CAST(floor((x0 + x1) / 1024) AS BIGINT) AS tc, CAST(floor((y0 + y1) / 1024) AS BIGINT) AS tr"
_IOU = """greatest(least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0), 0) * greatest(least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0), 0)"""


@query(
    f"""WITH RECURSIVE t AS (SELECT *, row_number() OVER (PARTITION BY slide_id, tc, tr ORDER BY score DESC, nucleus_id) AS k FROM (SELECT *, {_T} FROM detections)
      ), step AS (
        SELECT slide_id, tc, tr, k, [{{'id': nucleus_id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] AS kept FROM t WHERE k = 1
        UNION ALL
        SELECT t.slide_id, t.tc, t.tr, t.k, CASE WHEN len(list_filter(kept, lambda b: greatest(least(t.x1, b.x1) - greatest(t.x0, b.x0), 0) * greatest(least(t.y1, b.y1) - greatest(t.y0, b.y0), 0)
            > 0.1 * ((t.x1 - t.x0) * (t.y1 - t.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - greatest(least(t.x1, b.x1) - greatest(t.x0, b.x0), 0) * greatest(least(t.y1, b.y1) - greatest(t.y0, b.y0), 0)))) > 0 THEN kept
          ELSE list_append(kept, {{'id': t.nucleus_id, 'x0': t.x0, 'y0': t.y0, 'x1': t.x1, 'y1': t.y1}}) END
        FROM step JOIN t ON t.slide_id = step.slide_id AND t.tc = step.tc AND t.tr = step.tr AND t.k = step.k + 1
      ), last AS (SELECT slide_id, arg_max(kept, k) AS kept FROM step GROUP BY slide_id, tc, tr)
      SELECT slide_id, u.id AS nucleus_id FROM (SELECT slide_id, unnest(kept) AS u FROM last)""",
    "detections",
)
def J2_nms_by_tile(spark, sf_dir):
    on_workers(spark)
    tile = lambda a: F.floor((F.col(f"{a}0") + F.col(f"{a}1")) / 1024)
    (dets,) = tables(spark, sf_dir, "detections")
    return nms.nms_by_group(dets.withColumn("tc", tile("x")).withColumn("tr", tile("y")), ["slide_id", "tc", "tr"], 0.1).select("slide_id", "nucleus_id")


# Boxes meet in the bins of 64 pixels that they touch; a pair counts in the bin of its intersection's corner.
_PAIR = """WITH c AS MATERIALIZED (SELECT *, unnest(range(CAST(floor(x0 / 64) AS BIGINT), CAST(floor(x1 / 64) AS BIGINT) + 1)) AS bx FROM detections),
  n AS MATERIALIZED (SELECT *, unnest(range(CAST(floor(y0 / 64) AS BIGINT), CAST(floor(y1 / 64) AS BIGINT) + 1)) AS bin FROM c)
  SELECT a.slide_id, a.nucleus_id AS better, b.nucleus_id AS worse FROM n a JOIN n b ON a.slide_id = b.slide_id AND a.bx = b.bx AND a.bin = b.bin
  AND a.bx = CAST(floor(greatest(a.x0, b.x0) / 64) AS BIGINT) AND a.bin = CAST(floor(greatest(a.y0, b.y0) / 64) AS BIGINT)
  AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1 AND (a.score > b.score OR a.score = b.score AND a.nucleus_id < b.nucleus_id)
  WHERE {i} / ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {i}) > 0.1""".format(i=_IOU.format(a="a", b="b"))


@query(_PAIR, "detections")
def J2_overlapping_pairs(spark, sf_dir):
    return nms.overlapping_pairs(*tables(spark, sf_dir, "detections"), 0.1, 64)


@query(
    f"""WITH RECURSIVE pairs AS MATERIALIZED ({{}}), st USING KEY (slide_id, id) AS (
        SELECT slide_id, nucleus_id AS id, CASE WHEN (slide_id, nucleus_id) IN (SELECT (slide_id, worse) FROM pairs) THEN 0 ELSE 1 END AS s FROM detections
        UNION SELECT w.slide_id, w.id, CASE WHEN bool_or(b.s = 1) THEN 2 ELSE 1 END AS s FROM recurring.st w JOIN pairs p ON p.slide_id = w.slide_id AND p.worse = w.id JOIN recurring.st b ON b.slide_id = p.slide_id AND b.id = p.better
          WHERE w.s = 0 AND (SELECT count(*) FROM st) > 0 GROUP BY w.slide_id, w.id HAVING bool_or(b.s = 1) OR bool_and(b.s = 2))
      SELECT slide_id, id AS nucleus_id FROM st WHERE s = 1""".format(_PAIR),
    "detections",
)
def J2_nms_by_slide(spark, sf_dir):
    return nms.nms_by_slide(*tables(on_workers(spark), sf_dir, "detections"), 0.1).select("slide_id", "nucleus_id")


@query(f"SELECT slide_id, tc, tr, nucleus_id FROM (SELECT *, row_number() OVER (PARTITION BY slide_id, tc, tr ORDER BY score DESC, nucleus_id) AS k FROM (SELECT *, {_T} FROM detections)) WHERE k <= 20", "detections")
def K1_top_by_score(spark, sf_dir):
    tile = lambda a: F.floor((F.col(f"{a}0") + F.col(f"{a}1")) / 1024)
    (dets,) = tables(spark, sf_dir, "detections")
    return nms.top_by_score(dets.withColumn("tc", tile("x")).withColumn("tr", tile("y")), ["slide_id", "tc", "tr"], 20).select("slide_id", "tc", "tr", "nucleus_id")


@query("SELECT slide_id, 40 * (1 + CAST(slide_id % 3 <> 1 AS INT)) / 2.0E0 AS magnitude, CASE WHEN slide_id % 3 = 1 THEN 0.5E0 ELSE 0.25E0 END AS mpp FROM slides", "slides")
def Z1_header_numbers(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    return slides.select("slide_id", fn.magnification(F.col("description")).alias("magnitude"), fn.microns_per_pixel(F.col("description")).alias("mpp"))


@query("SELECT slide_id, 'slide_' || slide_id AS stem, '.svs' AS ext, 'height=4096|mpp=' || CAST(mpp AS VARCHAR) AS header FROM slides", "slides")
def Z3_names_and_headers(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    path = F.concat(F.lit("/data/batch.1/slide_"), F.col("slide_id").cast("string"), F.lit(".SVS"))
    header = fn.header_text(F.create_map(F.lit("mpp"), F.concat(F.col("mpp").cast("string"), F.lit("µ")), F.lit("height"), F.col("h").cast("string")))
    return slides.select("slide_id", fn.file_stem(path).alias("stem"), fn.file_extension(path).alias("ext"), header.alias("header"))


@query("SELECT slide_id, nucleus_id, (x1 - x0) * (y1 - y0) AS area FROM detections", "detections")
def Z4_polygon_area(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    return dets.select("slide_id", "nucleus_id", fn.polygon_area(_ring()).alias("area"))


def _ring():
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))


@query(
    """SELECT slide_id, nucleus_id, printf('%.2f,%.2f,%.2f,%.2f', x0, x1, x1, x0) AS poly_x, printf('%.2f,%.2f,%.2f,%.2f', y0, y0, y1, y1) AS poly_y, 4 AS n, round((x1 - x0) * (y1 - y0), 3) AS area FROM detections""",
    "detections",
)
def Z7_polygon_text(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    text = dets.withColumn("v", _ring()).select("slide_id", "nucleus_id", fn.vertices_to_text(F.col("v"), "x").alias("poly_x"), fn.vertices_to_text(F.col("v"), "y").alias("poly_y"))
    back = fn.text_to_vertices(F.col("poly_x"), F.col("poly_y"))
    return text.select("*", F.size(back).alias("n"), F.round(fn.polygon_area(back), 3).alias("area"))


@query(
    """SELECT slide_id, nucleus_id, round_even(x0, 0) AS even, round(sqrt(score), 9) AS root, round(ln(score), 9) AS log, round(score / (1 + score), 9) AS prob,
      CAST(floor((64 * ceil((x1 - x0) / 64) - (x1 - x0)) / 2) AS BIGINT) AS pad FROM detections""",
    "detections",
)
def Z8_rounding_and_logs(spark, sf_dir):
    (dets,) = tables(spark, sf_dir, "detections")
    w = F.col("x1") - F.col("x0")
    return dets.select(
        "slide_id", "nucleus_id", fn.half_even(F.col("x0")).alias("even"), F.round(F.sqrt("score"), 9).alias("root"), F.round(fn.positive_log(F.col("score")), 9).alias("log"),
        F.round(fn.sigmoid_of_log(F.col("score")), 9).alias("prob"), fn.center_padding(w, fn.next_multiple(w))["before"].alias("pad"),
    )
