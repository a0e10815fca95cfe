"""Tiles as pixel rows: colours, stains, normalisation, histograms, thresholds and tissue."""

from __future__ import annotations

from math import log

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.operators import raster

from nucleispark.functions.scalars import ratio

LUMA = (0.2125, 0.7154, 0.0721)


def rgba_to_rgb(pixels: DataFrame, background: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """r, g, b (0 to 1) over a background by alpha a; wholly clear pixels are background."""
    blend = {c: F.when(F.col("a") == 0, F.lit(bg)).otherwise(F.col(c) * F.col("a") + bg * (1 - F.col("a"))) for c, bg in zip("rgb", background, strict=True)}
    return pixels.withColumns(blend).drop("a")


def rgb_to_gray(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("gray", sum((F.col(c) * k for c, k in zip("rgb", LUMA, strict=True)), F.lit(0.0)))


def rgb_to_sda(pixels: DataFrame, channels: str = "rgb", top: float = 255.0, small: float = 1.0) -> DataFrame:
    """Optical density: 1 - ln(v + small) / ln(top + small)."""
    return pixels.withColumns({c: 1 - F.log(F.col(c) + small) / log(top + small) for c in channels})


def sda_to_rgb(pixels: DataFrame, channels: str = "rgb", top: float = 255.0, small: float = 1.0) -> DataFrame:
    return pixels.withColumns({c: F.greatest(F.lit(0.0), F.least(F.lit(top), F.pow(F.lit(top + small), 1 - F.col(c)) - small)) for c in channels})


def stain_matrix(stains: list[list[float]]) -> np.ndarray:
    """Unit rows; a third row at right angles to the first two where only two are given or the third is zero."""
    m = np.array(stains, float)
    m = np.vstack([m, np.zeros((3 - len(m), 3))])
    if not m[2].any():
        m[2] = np.cross(m[0], m[1])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _linear(pixels: DataFrame, source: list[str], target: list[str], m: np.ndarray) -> DataFrame:
    new = {t: sum((F.col(s) * float(m[i, j]) for i, s in enumerate(source)), F.lit(0.0)) for j, t in enumerate(target)}
    return pixels.withColumns(new)


def color_deconvolution(pixels: DataFrame, stains: list[list[float]]) -> DataFrame:
    """Adds s0, s1, s2: amounts of the stains (rows of the matrix) in densities r, g, b."""
    return _linear(pixels, list("rgb"), ["s0", "s1", "s2"], np.linalg.inv(stain_matrix(stains)))


def color_convolution(pixels: DataFrame, stains: list[list[float]]) -> DataFrame:
    """Replaces r, g, b by what s0, s1, s2 give."""
    return _linear(pixels, ["s0", "s1", "s2"], list("rgb"), stain_matrix(stains))


def normalize_pixels(pixels: DataFrame, key: str, column: str = "v", mean: float | None = None, std: float | None = None) -> DataFrame:
    """(v - mean) / std, by default of each image (population deviation); null for an even image."""
    if mean is not None and std is not None:
        return pixels.withColumn(column, (F.col(column) - mean) / std)
    own = pixels.groupBy(key).agg(F.avg(column).alias("_m"), F.stddev_pop(column).alias("_s"))
    return pixels.join(own, key).withColumn(column, ratio(F.col(column) - F.col("_m"), F.col("_s"))).drop("_m", "_s")


def rescale_intensity(pixels: DataFrame, key: str, column: str = "v", low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Stretches each image's least..greatest value to low..high; null for an even image."""
    own = pixels.groupBy(key).agg(F.min(column).alias("_a"), F.max(column).alias("_b"))
    return pixels.join(own, key).withColumn(column, ratio(F.col(column) - F.col("_a"), F.col("_b") - F.col("_a")) * (high - low) + low).drop("_a", "_b")


def histogram(pixels: DataFrame, keys: list[str], level: str = "level") -> DataFrame:
    return pixels.groupBy(*keys, level).agg(F.count("*").alias("n"))


def equalize(pixels: DataFrame, key: str, level: str = "level") -> DataFrame:
    """Adds cdf: the share of the image's pixels at or below the pixel's level."""
    order = Window.partitionBy(key).orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
    bins = histogram(pixels, [key], level)
    cdf = bins.withColumn("cdf", F.sum("n").over(order) / F.sum("n").over(Window.partitionBy(key))).drop("n")
    return pixels.join(cdf, [key, level])


def otsu(bins: DataFrame, keys: list[str], level: str = "level") -> DataFrame:
    """(keys, threshold) from (keys, level, n): the level that parts the histogram with the greatest variance between the two sides,
    levels >= threshold being the upper one; of equal ones the least. Null for one level only."""
    order = Window.partitionBy(*keys).orderBy(level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*keys)
    mass, moment = F.col("n"), F.col("n") * F.col(level)
    rows = bins.select(*keys, level, F.sum(mass).over(before).alias("w0"), F.sum(moment).over(before).alias("m0"), F.sum(mass).over(every).alias("w"), F.sum(moment).over(every).alias("m"))
    w1 = F.col("w") - F.col("w0")
    between = F.col("w0") * w1 * F.pow(F.col("m0") / F.col("w0") - (F.col("m") - F.col("m0")) / w1, F.lit(2.0))
    return rows.withColumn("_b", F.round(between, 6)).groupBy(*keys).agg(F.min_by(level, F.when(F.col("_b").isNotNull(), F.struct(-F.col("_b"), level))).alias("threshold"))


def entropy(bins: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, entropy) in bits, from (keys, level, n)."""
    total = bins.groupBy(*keys).agg(F.sum("n").alias("_w"))
    p = F.col("n") / F.col("_w")
    return bins.join(total, keys).groupBy(*keys).agg((-F.sum(p * F.log2(p))).alias("entropy"))


def tissue_blocks(blocks: DataFrame, key: str, channel: str = "channel", steps: int = 32) -> DataFrame:
    """(key, gr, gc) of the blocks (key, gr, gc, channel, level, n: histograms) whose entropy is at or over the image's Otsu threshold in
    some channel. Entropies are thresholded in 1/steps bits. Small parts and holes go by roi.fill_and_label."""
    cells = entropy(blocks, [key, "gr", "gc", channel]).withColumn("level", F.floor(F.col("entropy") * steps))
    cut = otsu(histogram(cells, [key, channel]), [key, channel])
    return cells.join(cut, [key, channel]).filter("level >= threshold").select(key, "gr", "gc").distinct()


def window_center(value: Column, center: float, width: float, low: float = 0.0, high: float = 255.0) -> Column:
    """Linear look-up of a window: below it low, above it high."""
    c, w = center - 0.5, width - 1
    inside = ((value - c) / w + 0.5) * (high - low) + low
    return F.when(value <= c - w / 2, low).when(value > c + w / 2, high).otherwise(inside)


def convert_pixels(value: Column, source: str, target: str) -> Column:
    """Between byte (0 to 255), float (0 to 1) and bool, with range and half-even rounding."""
    unit = {"byte": lambda v: v / 255.0, "float": lambda v: v.cast("double"), "bool": lambda v: v.cast("int").cast("double")}[source](value)
    return {"byte": lambda u: F.rint(F.greatest(F.lit(0.0), F.least(F.lit(1.0), u)) * 255).cast("int"), "float": lambda u: u, "bool": lambda u: u >= 0.5}[target](unit)


def image_stats(pixels: DataFrame, key: str, column: str = "v") -> DataFrame:
    return pixels.groupBy(key).agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count_distinct(column).alias("n_values"))


def tissue_from_pixels(pixels: DataFrame, key: str, sizes: DataFrame, channels: tuple[str, ...] = ("r", "g", "b"), block: int = 32, least_share: float = 0.0, steps: int = 32) -> DataFrame:
    """tissue_blocks of pixels (key, y, x, channels as 0 to 255) in blocks of `block` pixels, without holes and parts below
    least_share of the whole. sizes: (key, gh, gw) in blocks."""
    from nucleispark.operators.roi import fill_and_label

    each = F.array(*(F.struct(F.lit(c).alias("channel"), F.col(c).cast("int").alias("level")) for c in channels))
    at = pixels.select(key, F.floor(F.col("y") / block).cast("int").alias("gr"), F.floor(F.col("x") / block).cast("int").alias("gc"), F.inline(each))
    blocks = tissue_blocks(histogram(at, [key, "gr", "gc", "channel"], "level"), key, steps=steps)
    named = fill_and_label(blocks.withColumnRenamed(key, "slide_id"), sizes.withColumnRenamed(key, "slide_id"), least_share)
    return named.withColumnRenamed("slide_id", key)


def label_image(pixels: DataFrame) -> DataFrame:
    """(slide_id, y, x, label): of the pixels (slide_id, y, x, label) that detections cover, the greatest label at each place."""
    return pixels.groupBy("slide_id", "y", "x").agg(F.max("label").alias("label"))


def filled_pixels(dets: DataFrame) -> DataFrame:
    """The label image of filled integer boxes (x1, y1 outside)."""
    return raster.painted_pixels(raster.box_shapes(dets))


def outline_pixels(dets: DataFrame, border: int = 3) -> DataFrame:
    """(slide_id, y, x, label): pixels within `border` of the edges of integer boxes (x1, y1 outside); of boxes that overlap the greatest label.
    Boxes of at most two borders are filled. raster.painted_runs gives the same image without a row for each pixel."""
    return raster.painted_pixels(raster.box_shapes(dets, border))
