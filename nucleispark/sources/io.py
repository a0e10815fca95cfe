"""Reading and writing detections, annotations, plans and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nucleispark.functions.scalars import file_extension, file_stem, half_even, tile_key, vertices_to_text
from nucleispark.operators.features import feature_names, pivot_features

DETECTION_CSV = "x0 int, y0 int, x1 int, y1 int, score double, label string, poly_x string, poly_y string"
SERVICE = "id long, tile_key string, x0 float, y0 float, x1 float, y1 float, label int, score float, poly_x string, poly_y string, slide_id long"
_REGION = "_Text string, Vertices struct<Vertex:array<struct<_X:double,_Y:double>>>"


def list_inputs(spark: SparkSession, path: str, extensions: list[str] | None = None) -> DataFrame:
    """(path, relative, stem, extension) of files below a folder, without dot files; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    root = path.rstrip("/").split("://")[-1]
    out = files.select("path", F.regexp_replace("path", rf"^.*?\Q{root}\E/?", "").alias("relative"), file_stem(F.col("path")).alias("stem"), file_extension(F.col("path")).alias("extension"))
    out = out.filter(~F.col("relative").rlike(r"(^|/)\."))
    return out if extensions is None else out.filter(F.col("extension").isin(*extensions))


def pending(inputs: DataFrame, done: DataFrame, key: str = "slide_id") -> DataFrame:
    """Inputs without a result yet."""
    return inputs.join(done.select(key), key, "left_anti")


def pair_annotations(slides: DataFrame, annotations: DataFrame) -> DataFrame:
    """Slides (path, stem, ..) with the annotation file of the same folder and stem, or null."""
    folder = lambda c: F.regexp_extract(c, r"^(.*?)/?[^/]*$", 1)
    ann = annotations.select(folder("path").alias("_d"), F.col("stem").alias("_s"), F.col("path").alias("ann_file"))
    own = slides.withColumn("_d", folder("path"))
    return own.join(ann, (own["_d"] == ann["_d"]) & (own["stem"] == ann["_s"]), "left").drop("_d", "_s")


def read_detections(spark: SparkSession, path: str, schema: str = DETECTION_CSV, form: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if form == "csv" else reader.format(form).load(path)


def export_detections(dets: DataFrame, classes: DataFrame | None = None, save_masks: bool = False) -> DataFrame:
    """Half-even integer boxes, scores to four decimals, labels as text (`cls_n` if unknown) where classes are given, and with save_masks
    the polygons (mask_poly, relative to the rounded box's corner) as comma-joined slide coordinates."""
    corners = [half_even(F.col(c)).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")]
    if classes is not None:
        # A class table has few rows; by label alone all detections would meet in a few tasks.
        dets = dets.join(F.broadcast(classes.select("label", F.col("text").alias("_text"))), "label", "left")
        label = F.coalesce("_text", F.concat(F.lit("cls_"), F.col("label").cast("string")))
    else:
        label = F.col("label")
    out = [*[c for c in ("slide_id", "nucleus_id") if c in dets.columns], *corners, F.round("score", 4).alias("score"), label.alias("label")]
    if save_masks:
        placed = F.transform("mask_poly", lambda p: F.struct((p["x"] + half_even(F.col("x0"))).alias("x"), (p["y"] + half_even(F.col("y0"))).alias("y")))
        out += [vertices_to_text(placed, a).alias(f"poly_{a}") for a in "xy"]
    return dets.select(*out)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """(path, label, vertices) of every Region of XML annotation files."""
    regions = spark.read.format("xml").option("rowTag", "Region").schema(_REGION).load(path)
    vertices = F.transform("Vertices.Vertex", lambda v: F.struct(v["_X"].alias("x"), v["_Y"].alias("y")))
    return regions.select(F.col("_metadata.file_path").alias("path"), F.col("_Text").alias("label"), vertices.alias("vertices"))


#: Fixed values of the class table.
CLASSES = [
    (-100, "unlabeled", "#949494"), (0, "(bg)", "#ffffff"), (1, "tumor", "#00ff00"), (2, "stromal", "#ff0000"), (3, "sTILs", "#0000ff"), (4, "blood", "#ff00ff"),
    (5, "macrophage", "#ffff00"), (6, "dead", "#0094e1"), (7, "other", "#646464"),
]


def class_table(spark: SparkSession, rows: list[tuple[int, str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(rows or CLASSES, "label int, text string, color string")


def read_patient_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema("slide_id string, patient_id string").csv(path)


def append_detections(dets: DataFrame, path: str, level: int = 0) -> None:
    """Adds tile results (slide_id, tile_col, tile_row, ..) to a Parquet table by slide, with tile_key `level_col_row`."""
    dets.withColumn("tile_key", tile_key(F.lit(level), F.col("tile_col"), F.col("tile_row"))).write.mode("append").partitionBy("slide_id").parquet(path)


def write_plan(tiles: DataFrame, path: str) -> None:
    tiles.write.mode("overwrite").partitionBy("slide_id").parquet(path)


def read_plan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The written plan; without its schema, slide ids get the type that their folder names suggest."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def write_feature_summary(features: DataFrame, entity: str, n_classes: int, path: str) -> None:
    """One CSV row for each slide or patient, with fixed columns."""
    pivot_features(features, entity, feature_names(n_classes)).write.mode("overwrite").option("header", True).csv(path)


def attach_masks(dets: DataFrame, masks: DataFrame) -> DataFrame:
    """Detections with their mask row, or nulls."""
    return dets.join(masks, ["slide_id", "nucleus_id"], "left")
