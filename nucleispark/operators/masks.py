"""Masks as pixel rows (keys, y, x), run lengths, polygons; overlaps between label images; annotation rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.functions.scalars import ratio
from nucleispark.kernels.components import label as components
from nucleispark.kernels.contour import area, contours, resize
from nucleispark.kernels.regionprops import NAMES, region_properties
from nucleispark.operators import raster
from nucleispark.operators.batches import deal


def rle_encode(pixels: DataFrame, key: str, h: int, value: str = "mask") -> DataFrame:
    """(key, counts): run lengths in column-major order of a full grid (key, y, x, mask boolean), the first run being unset pixels (0 if none)."""
    place = F.col("x") * h + F.col("y")
    order = Window.partitionBy(key).orderBy("_p")
    rows = pixels.select(key, place.alias("_p"), F.col(value).cast("boolean").alias("_v"))
    change = F.coalesce(F.col("_v") != F.lag("_v").over(order), F.col("_v"))
    runs = rows.withColumn("_run", F.sum(change.cast("int")).over(order)).groupBy(key, "_run").agg(F.count("*").cast("int").alias("n"), F.first("_v").alias("_v"))
    listed = runs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_run", "n"))).alias("runs"))
    counts = F.transform("runs", lambda r: r["n"])
    return listed.select(key, F.when(F.get("runs", F.lit(0))["_run"] == 1, F.concat(F.array(F.lit(0)), counts)).otherwise(counts).alias("counts"))


def rle_decode(runs: DataFrame, key: str, h: int) -> DataFrame:
    """(key, y, x) of the set pixels."""
    upto = F.transform("counts", lambda c, i: F.struct(F.aggregate(F.slice("counts", 1, i), F.lit(0), lambda s, x: s + x).alias("begin"), c.alias("n"), (i % 2).alias("on")))
    spans = runs.select(key, F.inline(upto)).filter("on = 1 and n > 0")
    at = spans.select(key, F.explode(F.sequence("begin", F.col("begin") + F.col("n") - 1)).alias("p"))
    return at.select(key, (F.col("p") % h).cast("int").alias("y"), F.floor(F.col("p") / h).cast("int").alias("x"))


def mask_bbox(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x0, y0, x1, y1, area) of set pixels; the last row and column are in the box."""
    return pixels.groupBy(*keys).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"), F.count("*").alias("area"))


def iou_by_class(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cls, iou, dice) from label images (keys, truth, predicted), one row a pixel. Both are null for a class that neither has."""
    classes = F.array_distinct(F.array("truth", "predicted"))
    rows = pairs.select(*keys, F.explode(classes).alias("cls"), (F.col("truth") == F.col("predicted")).cast("int").alias("both"), F.size(classes).alias("n"))
    sums = rows.groupBy(*keys, "cls").agg(F.sum("both").alias("inter"), F.count("*").alias("union"))
    return sums.select(*keys, "cls", ratio(F.col("inter"), F.col("union")).alias("iou"), ratio(2 * F.col("inter"), F.col("union") + F.col("inter")).alias("dice"))


def semantic_masks(instances: DataFrame, grid: DataFrame, key: str) -> DataFrame:
    """(key, label, y, x): the union of instance pixels by label, and label 0 for all pixels of the grid without one."""
    union = instances.select(key, "label", "y", "x").distinct()
    rest = grid.select(key, "y", "x").join(union, [key, "y", "x"], "left_anti").select(key, F.lit(0).alias("label"), "y", "x")
    return union.unionByName(rest)


def split_masks(values: DataFrame, key: str, h: int, w: int, least_area: int = 2) -> DataFrame:
    """(key, value, instance, y, x): the 4-connected parts of each value but 0 of an image (key, y, x, value), without tiny ones."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((h, w), np.int64)
        image[pdf["y"], pdf["x"]] = pdf["value"]
        parts, last = [], 0
        for v in np.unique(image[image != 0]):
            numbers, n = components(image == v)
            size = np.bincount(numbers.ravel(), minlength=n + 1)
            for k in range(1, n + 1):
                if size[k] >= least_area:
                    last += 1
                    y, x = np.nonzero(numbers == k)
                    parts.append(pd.DataFrame({key: pdf[key].iloc[0], "value": int(v), "instance": last, "y": y, "x": x}))
        return pd.concat(parts) if parts else pd.DataFrame({key: [], "value": [], "instance": [], "y": [], "x": []})

    return deal(values, key).groupBy(key).applyInPandas(one, f"{key} {values.schema[key].dataType.simpleString()}, value int, instance int, y int, x int")


def merge_masks(instances: DataFrame, key: str) -> DataFrame:
    """(key, y, x, value): instances back in one image; where they overlap their numbers add."""
    return instances.groupBy(key, "y", "x").agg(F.sum("instance").cast("int").alias("value"))


def polygons_to_pixels(polygons: DataFrame, key: str, h: int, w: int) -> DataFrame:
    """(key, y, x): pixels of the grid inside of or on polygons (key, vertices array<struct<x,y>>), those of a key being the outer and
    inner rings of one shape (even-odd rule)."""
    runs = raster.merged_runs(raster.polygon_runs(polygons, [key]), [key]).filter((F.col("y") >= 0) & (F.col("y") < h))
    cut = runs.withColumns({"x0": F.greatest("x0", F.lit(0)), "x1": F.least("x1", F.lit(w - 1))}).filter("x0 <= x1")
    return raster.run_pixels(cut).select(key, "y", "x")


def pixels_to_polygons(pixels: DataFrame, key: str, h: int, w: int, scale: float = 1.0) -> DataFrame:
    """(key, ring, vertices, area): contours at 0.5 of masks (key, y, x), cut to the pixel grid."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros((h, w), bool)
        mask[pdf["y"], pdf["x"]] = True
        rings = [r * scale for r in contours(mask)]
        return pd.DataFrame({key: pdf[key].iloc[0], "ring": range(len(rings)), "vertices": pd.Series([[{"x": float(x), "y": float(y)} for y, x in r] for r in rings], dtype=object), "area": [area(r) for r in rings]})

    return deal(pixels, key).groupBy(key).applyInPandas(one, f"{key} {pixels.schema[key].dataType.simpleString()}, ring int, vertices array<struct<x:double,y:double>>, area double")


def mask_pixels(dets: DataFrame, side: int = 28) -> DataFrame:
    """(slide_id, y, x, label): the pixels of each detection's mask (soft: side * side values, over 0.5 at the box's size)."""
    schema = f"slide_id {dets.schema['slide_id'].dataType.simpleString()}, y int, x int, label {dets.schema['label'].dataType.simpleString()}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            corner = {c: np.rint(pdf[c].to_numpy(float)).astype(int) for c in ("x0", "y0", "x1", "y1")}
            w, h = np.maximum(corner["x1"] - corner["x0"] + 1, 1), np.maximum(corner["y1"] - corner["y0"] + 1, 1)
            for s, slide, label, x, y, a, b in zip(pdf["soft"], pdf["slide_id"], pdf["label"], corner["x0"], corner["y0"], w, h, strict=True):
                i, j = np.nonzero(resize(np.asarray(s, float).reshape(side, side), int(b), int(a)) > 0.5)
                yield pd.DataFrame({"slide_id": slide, "y": i + y, "x": j + x, "label": label})

    return dets.select("slide_id", "label", "x0", "y0", "x1", "y1", "soft").mapInPandas(run, schema)


def polygon_pixels(polygons: DataFrame) -> DataFrame:
    """(slide_id, y, x, label): the pixels of each polygon (slide_id, label, vertices); where they overlap the greatest label."""
    own = polygons.select("slide_id", "label", "vertices", F.monotonically_increasing_id().alias("_i"))
    runs = raster.polygon_runs(own, ["slide_id", "label", "_i"]).drop("_i")
    return raster.run_pixels(raster.label_runs(runs)).select("slide_id", "y", "x", "label")


def region_props(dets: DataFrame, side: int = 28, names: tuple[str, ...] = NAMES, more: dict[str, Callable[[np.ndarray], float | None]] | None = None) -> DataFrame:
    """Detections (with soft, an array of side * side mask values) with the chosen properties of the mask at the box's size; null for
    empty masks. more: the caller's own properties, functions of the boolean mask by their names."""
    own = dict(more or {})
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dets.drop("soft").schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            corner = {c: np.rint(pdf[c].to_numpy(float)).astype(int) for c in ("x0", "y0", "x1", "y1")}
            w, h = np.maximum(corner["x1"] - corner["x0"] + 1, 1), np.maximum(corner["y1"] - corner["y0"] + 1, 1)
            shapes = [resize(np.asarray(s, float).reshape(side, side), int(b), int(a)) > 0.5 for s, a, b in zip(pdf["soft"], w, h, strict=True)]
            found = [region_properties(m) | {n: f(m) if m.any() else None for n, f in own.items()} for m in shapes]
            out = pdf.drop(columns="soft")
            for n in (*names, *own):
                out[n] = pd.array([f[n] for f in found], dtype="Float64")
            yield out

    return dets.mapInPandas(run, schema + "".join(f", {n} double" for n in (*names, *own)))


_COCO = "id long, image_id long, category_id int, segmentation array<int>, area double, bbox array<int>, iscrowd int"


def to_coco(pixels: DataFrame, h: int, w: int) -> DataFrame:
    """(id, json): crowd annotation rows with run lengths, of masks (id, image_id, label, y, x, mask) on full grids."""
    runs = rle_encode(pixels, "id", h)
    box = mask_bbox(pixels.filter("mask"), ["id", "image_id", "label"])
    row = F.struct(
        F.col("id").cast("long").alias("id"), F.col("image_id").cast("long").alias("image_id"), F.col("label").cast("int").alias("category_id"), F.col("counts").alias("segmentation"),
        F.col("area").cast("double").alias("area"), F.array("x0", "y0", F.col("x1") - F.col("x0") + 1, F.col("y1") - F.col("y0") + 1).alias("bbox"), F.lit(1).alias("iscrowd"),
    )
    return box.join(runs, "id").select("id", F.to_json(row).alias("json"))


def from_coco(rows: DataFrame, h: int) -> DataFrame:
    """(id, image_id, label, y, x) of the set pixels of crowd rows."""
    own = rows.select(F.from_json("json", _COCO).alias("a")).select("a.*")
    pixels = rle_decode(own.select("id", F.col("segmentation").alias("counts")), "id", h)
    return pixels.join(own.select("id", "image_id", F.col("category_id").alias("label")), "id")


_COCO_POLYGON = "id long, image_id long, category_id int, segmentation array<array<double>>, iscrowd int"


def to_coco_polygons(polygons: DataFrame) -> DataFrame:
    """(id, json): annotation rows with flat polygons, of (id, image_id, label, vertices)."""
    from nucleispark.functions.scalars import polygon_area

    side = lambda f, c: f(F.col("vertices")[c])
    x0, y0 = side(F.array_min, "x"), side(F.array_min, "y")
    row = F.struct(
        F.col("id").cast("long").alias("id"), F.col("image_id").cast("long").alias("image_id"), F.col("label").cast("int").alias("category_id"),
        F.array(F.flatten(F.transform("vertices", lambda p: F.array(p["x"], p["y"])))).alias("segmentation"), polygon_area(F.col("vertices")).alias("area"),
        F.array(x0, y0, side(F.array_max, "x") - x0, side(F.array_max, "y") - y0).alias("bbox"), F.lit(0).alias("iscrowd"),
    )
    return polygons.select("id", F.to_json(row).alias("json"))


def from_coco_polygons(rows: DataFrame) -> DataFrame:
    """(id, image_id, label, ring, vertices) of the polygons of rows that are no crowds."""
    own = rows.select(F.from_json("json", _COCO_POLYGON).alias("a")).select("a.*")
    no_crowd = F.when(F.col("iscrowd") == 0, F.col("segmentation"))  # as a filter it would parse a row again for each of its conditions
    rings = own.select("id", "image_id", F.col("category_id").alias("label"), F.posexplode(no_crowd).alias("ring", "flat"))
    at = F.sequence(F.lit(0), F.floor(F.size("flat") / 2).cast("int") - 1)
    point = lambda i: F.struct(F.get("flat", 2 * i).alias("x"), F.get("flat", 2 * i + 1).alias("y"))
    return rings.select("id", "image_id", "label", "ring", F.when(F.size("flat") > 1, F.transform(at, point)).alias("vertices"))
