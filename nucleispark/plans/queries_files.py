"""Queries on files: what is written to the shared folder and read back, annotation files, stored tile requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from nucleispark.operators import annotations, boxes, features, tiles
from nucleispark.plans.fixtures import tables
from nucleispark.plans.queries_boxes import _CLASSES, _ring
from nucleispark.plans.registry import query
from nucleispark.session import new_folder, on_workers
from nucleispark.sources import io, tile_table
from nucleispark.streaming import batching
from nucleispark.streaming import requests as stream

_REGIONS = """regions AS (SELECT slide_id, CAST(label AS INT) AS region_id, 'cls_' || label AS label, min(x0) AS left_x, min(y0) AS top_y, max(x1) AS right_x, max(y1) AS bottom_y
  FROM detections GROUP BY slide_id, detections.label)"""


def _regions(spark, sf_dir):
    """A region around all boxes of a label on a slide."""
    (dets,) = tables(spark, sf_dir, "detections")
    found = dets.groupBy("slide_id", "label").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return found.select("slide_id", F.col("label").cast("int").alias("region_id"), F.concat(F.lit("cls_"), F.col("label").cast("string")).alias("label"), _ring().alias("vertices"))


def _annotation_files(spark, sf_dir) -> str:
    """A folder with an XML file of regions for each slide."""
    folder = new_folder(spark, "annotations")
    vertices = F.transform("vertices", lambda v: F.struct(v["x"].alias("_X"), v["y"].alias("_Y")))
    rows = _regions(spark, sf_dir).select("slide_id", F.col("label").alias("_Text"), F.struct(vertices.alias("Vertex")).alias("Vertices"))
    rows.repartition("slide_id").write.format("xml").option("rootTag", "Regions").option("rowTag", "Region").partitionBy("slide_id").save(folder)
    return folder


def _slide_of(path: str):
    return F.regexp_extract(path, r"slide_id=(-?\d+)/", 1).cast("long").alias("slide_id")


@query("SELECT DISTINCT slide_id, '.xml' AS extension, true AS has_stem FROM detections", "detections")
def S1_list_inputs(spark, sf_dir):
    files = io.list_inputs(spark, _annotation_files(spark, sf_dir), [".xml"])
    return files.select(_slide_of("relative"), "extension", (F.length("stem") > 0).alias("has_stem")).distinct()


@query(
    f"""WITH {_CLASSES}, d AS (SELECT *, round_even(x0, 0) + 0.0E0 AS rx0, round_even(y0, 0) + 0.0E0 AS ry0 FROM detections)
      SELECT CAST(rx0 AS INT) AS x0, CAST(ry0 AS INT) AS y0, CAST(round_even(x1, 0) AS INT) AS x1, CAST(round_even(y1, 0) AS INT) AS y1, round(score, 4) AS score, coalesce(text, 'cls_' || label) AS label,
      printf('%.2f,%.2f,%.2f,%.2f', rx0, rx0 + x1 - x0, rx0 + x1 - x0, rx0) AS poly_x, printf('%.2f,%.2f,%.2f,%.2f', ry0, ry0, ry0 + y1 - y0, ry0 + y1 - y0) AS poly_y FROM d LEFT JOIN classes USING (label)""",
    "detections",
)
def S2_read_detections(spark, sf_dir):
    """Boxes with their outlines, exported as CSV and read back."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    w, h, zero = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(0.0)
    dets = tables(spark, sf_dir, "detections")[0].withColumn("mask_poly", F.array(corner(zero, zero), corner(w, zero), corner(w, h), corner(zero, h)))
    folder = new_folder(spark, "detections")
    io.export_detections(dets, io.class_table(spark), save_masks=True).drop("slide_id", "nucleus_id").write.option("header", True).csv(folder)
    return io.read_detections(spark, folder)


@query(f"WITH {_REGIONS} SELECT slide_id, label, 4 AS n, left_x, top_y, right_x, bottom_y FROM regions", "detections")
def S4_read_annotations(spark, sf_dir):
    found = io.read_annotations(spark, _annotation_files(spark, sf_dir))
    end = lambda least_or_most, axis: least_or_most(F.col(f"vertices.{axis}"))
    ends = [end(F.array_min, "x").alias("left_x"), end(F.array_min, "y").alias("top_y"), end(F.array_max, "x").alias("right_x"), end(F.array_max, "y").alias("bottom_y")]
    return found.select(_slide_of("path"), "label", F.size("vertices").alias("n"), *ends)


@query("SELECT slide_id, CASE WHEN mpp = 0.25 THEN '/data/p' || patient_id || '/s' || slide_id || '.xml' END AS ann_file FROM slides", "slides")
def S5_pair_annotations(spark, sf_dir):
    """Slides of 0.25 micrometres a pixel have a file beside them; the others have one of that name in another folder."""
    (slides,) = tables(spark, sf_dir, "slides")
    stem = F.concat(F.lit("s"), F.col("slide_id").cast("string"))
    folder = F.concat(F.lit("/data/p"), F.col("patient_id").cast("string"))
    files = slides.select("slide_id", F.concat_ws("/", folder, F.concat(stem, F.lit(".svs"))).alias("path"), stem.alias("stem"))
    where = F.when(F.col("mpp") == 0.25, folder).otherwise(F.lit("/data/old"))
    ann = slides.select(F.concat_ws("/", where, F.concat(stem, F.lit(".xml"))).alias("path"), stem.alias("stem"))
    return io.pair_annotations(files, ann).select("slide_id", "ann_file")


@query(
    """SELECT slide_id, CAST(nullif(count(*) FILTER (label = 1), 0) AS DOUBLE) AS tumor, CAST(nullif(count(*) FILTER (label = 2), 0) AS DOUBLE) AS stromal, CAST(nullif(count(*) FILTER (label = 3), 0) AS DOUBLE) AS stils,
      CAST(NULL AS DOUBLE) AS roi_area FROM detections WHERE label BETWEEN 1 AND 3 GROUP BY slide_id""",
    "detections",
)
def S8_feature_summary(spark, sf_dir):
    """The wide CSV of one family of features; columns of the others are there and empty."""
    totals = features.label_totals(boxes.filter_labels(*tables(spark, sf_dir, "detections"), 3))
    long = features.long_features(totals, "slide_id", (F.col("label") - 1).cast("string"), {"count": F.col("total")})
    folder = new_folder(spark, "summary")
    io.write_feature_summary(long, "slide_id", 3, folder)
    names = {"slide_id": "long"} | {n: "double" for n in features.feature_names(3)}
    wide = spark.read.option("header", True).schema(", ".join(f"`{n}` {t}" for n, t in names.items())).csv(folder)
    return wide.select("slide_id", *(F.col(f"`{c}.count`").alias(n) for c, n in enumerate(("tumor", "stromal", "stils"))), "roi_area")


@query("SELECT CAST(patient_id AS VARCHAR) AS patient_id, count(DISTINCT slide_id) AS slides, count(*) AS nuclei FROM detections JOIN slides USING (slide_id) GROUP BY ALL", "detections", "slides")
def S11_patient_map(spark, sf_dir):
    dets, slides = tables(spark, sf_dir, "detections", "slides")
    folder = new_folder(spark, "patients")
    slides.select("slide_id", "patient_id").write.option("header", True).csv(folder)
    counts = dets.groupBy(F.col("slide_id").cast("string").alias("slide_id")).agg(F.count("*").alias("n"))
    return counts.join(io.read_patient_map(spark, folder), "slide_id").groupBy("patient_id").agg(F.count("*").alias("slides"), F.sum("n").alias("nuclei"))


@query(
    """SELECT slide_id, CAST(c AS INT) AS tile_col, CAST(r AS INT) AS tile_row, CAST(c * 500 AS INT) AS x, CAST(r * 500 AS INT) AS y, CAST(least(500, 4096 - c * 500) AS INT) AS w, CAST(least(500, 4096 - r * 500) AS INT) AS h
      FROM slides, range(9) AS a(c), range(9) AS b(r)""",
    "slides",
)
def S13_tile_plan(spark, sf_dir):
    (slides,) = tables(spark, sf_dir, "slides")
    plan = tiles.tile_grid(slides.select("slide_id", "h", "w"), 500)
    folder = new_folder(spark, "plan")
    io.write_plan(plan, folder)
    return io.read_plan(spark, folder, plan.schema).drop("slide_h", "slide_w")


@query(
    """WITH d AS MATERIALIZED (SELECT slide_id, nucleus_id, label, (x1 - x0) * (y1 - y0) AS area FROM detections), m AS MATERIALIZED (SELECT slide_id, nucleus_id, area FROM d WHERE label > 0)
      SELECT d.slide_id, d.nucleus_id, m.area FROM d LEFT JOIN m ON m.slide_id = d.slide_id AND m.nucleus_id = d.nucleus_id""",
    "detections",
)
def J5_attach_masks(spark, sf_dir):
    """Masks exist for nuclei of a class."""
    (dets,) = tables(spark, sf_dir, "detections")
    masks = dets.filter("label > 0").select("slide_id", "nucleus_id", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    return io.attach_masks(dets.select("slide_id", "nucleus_id"), masks)


@query(
    f"""WITH {_REGIONS}, r AS (SELECT slide_id, region_id, label FROM regions)
      SELECT 'xml' AS mode, * FROM r UNION ALL SELECT 'pattern', * FROM r WHERE region_id IN (1, 2) UNION ALL SELECT 'tissue', slide_id, 0, 'tissue' FROM slides
      UNION ALL SELECT 'given', slide_id, 0, 'tissue' FROM slides UNION ALL SELECT 'function', * FROM r WHERE region_id > 2""",
    "detections", "slides",
)
def P9_roi_regions(spark, sf_dir):
    """All ways to name a region of interest but the whole slide, which is no region."""
    found = _regions(spark, sf_dir).drop("vertices")
    tissue = tables(spark, sf_dir, "slides")[0].select("slide_id", F.lit(0).alias("region_id"), F.lit("tissue").alias("label"))
    modes = {"xml": "xml", "pattern": "cls_[12]$", "tissue": "tissue", "given": tissue, "function": lambda a: a.filter("region_id > 2")}
    parts = [annotations.roi_regions(found, m, tissue).select(F.lit(n).alias("mode"), "slide_id", "region_id", "label") for n, m in modes.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT DISTINCT slide_id, tile_col, tile_row, tile_col * tile_row AS score FROM requests", "requests")
def T4_stored_batches(spark, sf_dir):
    """Requests as a stream of files, a few in a batch; each tile is scored and stored once, whatever its time."""
    (rows,) = tables(spark, sf_dir, "requests")
    folder = new_folder(spark, "requests")
    rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "slide_id", "tile_col", "tile_row").repartition(8, "event_id").write.parquet(f"{folder}/in")
    score = lambda t: t.select("slide_id", "tile_col", "tile_row", (F.col("tile_col") * F.col("tile_row")).alias("score"))
    stream.serve(stream.read_requests(spark, f"{folder}/in", 3), score, f"{folder}/out", f"{folder}/state", once_only=False, all_available=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


@query("SELECT slide_id, count(DISTINCT (tile_col, tile_row)) AS finished, count(DISTINCT (tile_col, tile_row)) / 64 AS share FROM requests GROUP BY slide_id", "requests")
def T5_exact_progress(spark, sf_dir):
    """The last state of a replayed stream of requests, with a set of tiles for each slide."""
    (rows,) = tables(on_workers(spark), sf_dir, "requests")
    folder = new_folder(spark, "progress")
    rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "slide_id", "tile_col", "tile_row").repartition(4, "event_id").write.parquet(f"{folder}/in")
    found = batching.exact_progress(stream.read_requests(spark, f"{folder}/in", 2), 64)
    store = lambda part, number: part.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
    found.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("slide_id").agg(F.max("finished").alias("finished"), F.max("share").alias("share"))


_TILED = "SELECT *, CAST(least(floor((x0 + x1) / 2 / 512), 7) AS INT) AS tile_col, CAST(least(floor((y0 + y1) / 2 / 512), 7) AS INT) AS tile_row FROM detections"


def _tile_table(spark, sf_dir) -> str:
    """Detections appended by tile rows in two batches, with a failed batch before and a repeated one after."""
    (dets,) = tables(spark, sf_dir, "detections")
    at = lambda a: F.least(F.floor((F.col(f"{a}0") + F.col(f"{a}1")) / 2 / 512), F.lit(7)).cast("int")
    own = dets.withColumns({"tile_col": at("x"), "tile_row": at("y")})
    folder = new_folder(spark, "tiles")
    own.filter("tile_row < 2").write.parquet(f"{folder}/data/batch=1")  # without a manifest
    for batch in (0, 1, 1):
        tile_table.append_tiles(own.filter((F.col("tile_row") % 2) == batch), folder, batch)
    return folder


@query(f"SELECT slide_id, '0_' || tile_col || '_' || tile_row AS tile_key, count(*) AS n, round(sum(score), 6) AS total FROM ({_TILED}) GROUP BY ALL", "detections")
def S10_append_tiles(spark, sf_dir):
    found = tile_table.read_tiles(spark, _tile_table(spark, sf_dir))
    return found.groupBy("slide_id", "tile_key").agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("total"))


@query(f"SELECT nucleus_id, x0, y0, x1, y1, label FROM ({_TILED}) WHERE slide_id = 0 AND tile_col BETWEEN 2 AND 4 AND tile_row BETWEEN 3 AND 5", "detections")
def P12_fetch_stored_tiles(spark, sf_dir):
    """A tile with its neighbours, read from the stored table."""
    stored = tile_table.read_tiles(spark, _tile_table(spark, sf_dir))
    return tile_table.fetch_tiles(stored, 0, 3, 4, 1).select("nucleus_id", "x0", "y0", "x1", "y1", "label")
