"""Points in patches, patch choice, Delaunay edges and their statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.kernels.delaunay import triangulate
from nucleispark.operators.batches import deal, whole_groups
from nucleispark.operators.features import each_class


def points_in_patches(cells: DataFrame, patches: DataFrame, bin_size: int) -> DataFrame:
    """Rows of cells (slide_id, cls, row, col) in each patch (slide_id, patch_id, x, y, w, h), upper and left borders included.

    A patch is listed under the bins it touches, a point under its own one; they meet by equality of bins. bin_size near the
    patches' size gives each patch four bins at most.
    """
    bins = lambda a, n: F.sequence(F.floor(F.col(a) / bin_size), F.floor((F.col(a) + F.col(n) - 1) / bin_size))
    spread = patches.select("slide_id", "patch_id", F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("w").alias("_w"), F.col("h").alias("_h"), F.explode(bins("x", "w")).alias("_bx"), bins("y", "h").alias("_by"))
    spread = spread.withColumn("_by", F.explode("_by"))
    near = cells.withColumns({"_bx": F.floor(F.col("col") / bin_size), "_by": F.floor(F.col("row") / bin_size)}).join(spread, ["slide_id", "_bx", "_by"])
    inside = (F.col("col") >= F.col("_x")) & (F.col("col") < F.col("_x") + F.col("_w")) & (F.col("row") >= F.col("_y")) & (F.col("row") < F.col("_y") + F.col("_h"))
    return near.filter(inside).select(*cells.columns, "patch_id")


def score_patches(patches: DataFrame, cells: DataFrame, bin_size: int, core: tuple[int, ...] = (0,)) -> DataFrame:
    """Patches with n_points, their occupied pixels, and n_core, those of core classes, which is the score."""
    found = points_in_patches(cells, patches, bin_size).groupBy("slide_id", "patch_id").agg(F.count("*").alias("n_points"), F.count_if(F.col("cls").isin(*core)).alias("n_core"))
    return patches.join(found, ["slide_id", "patch_id"], "left").fillna(0, ["n_points", "n_core"])


def patch_coverage(patches: DataFrame, roi_pixels: DataFrame, bin_size: int) -> DataFrame:
    """Adds the share of each patch that the mask (slide_id, row, col) covers."""
    found = points_in_patches(roi_pixels, patches, bin_size).groupBy("slide_id", "patch_id").agg(F.count("*").alias("_n"))
    joined = patches.join(found, ["slide_id", "patch_id"], "left")
    return joined.withColumn("coverage", F.coalesce(F.col("_n") / (F.col("w") * F.col("h")), F.lit(0.0))).drop("_n")


def best_patches(scored: DataFrame, n: int, score: str | Column = "n_core") -> DataFrame:
    """The n best patches of each slide with their rank, by a column or an expression of the caller's; of equal scores the least
    patch_id first."""
    order = Window.partitionBy("slide_id").orderBy(F.desc(score), "patch_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def choose_patches(scored: DataFrame, n: int = 10, least: int = 10, pool: int = 2) -> DataFrame:
    """The first n patches, by score, of the best pool * n, that have enough points and core points."""
    best = best_patches(scored, pool * n).filter((F.col("n_points") >= least) & (F.col("n_core") >= least))
    order = Window.partitionBy("slide_id").orderBy("rank")
    return best.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= n).drop("_k")


def patch_counts(points: DataFrame, dets: DataFrame, n_classes: int) -> DataFrame:
    """(slide_id, cls, n): occupied pixels of each class in the chosen patches, 0 for classes without."""
    found = points.groupBy("slide_id", "cls").agg(F.count("*").alias("n"))
    return each_class(dets, n_classes).join(found, ["slide_id", "cls"], "left").fillna(0, ["n"])


def delaunay_edges(points: DataFrame, max_dist: float | None = 100.0, keys: tuple[str, ...] = ("slide_id", "patch_id")) -> DataFrame:
    """(keys, i, j, dist): the three sides of each triangle over a patch's points, i <= j being their classes.

    Sides inside the hull thus come twice. Kept are sides with 0 < dist < max_dist. Where classes share a pixel the least class
    stands for it. Of the triangulations of points on one circle the one is taken that lifting the points by ever smaller steps, in
    order of row and column, leads to.
    """

    names = list(keys)

    def sides(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of whole patches, sorted."""
        pdf = pdf[~pdf.duplicated([*names, "row", "col"])]
        begins = np.flatnonzero((pdf[names] != pdf[names].shift()).any(axis=1).to_numpy())
        xy, cls = pdf[["row", "col"]].to_numpy(np.int64), pdf["cls"].to_numpy()
        tri = triangulate(xy, np.append(begins, len(pdf)))
        i, j = tri.ravel(), tri[:, [1, 2, 0]].ravel()
        found = {"i": np.minimum(cls[i], cls[j]), "j": np.maximum(cls[i], cls[j]), "dist": np.sqrt(((xy[i] - xy[j]) ** 2).sum(1).astype(float))}
        return pd.DataFrame({**{k: pdf[k].to_numpy()[i] for k in names}, **found})

    kinds = ", ".join(f"{k} {points.schema[k].dataType.simpleString()}" for k in keys)
    dealt = deal(points.select(*names, "row", "col", "cls"), *names).sortWithinPartitions(*names, "row", "col", "cls")
    edges = dealt.mapInPandas(whole_groups(names, sides), f"{kinds}, i int, j int, dist double")
    edges = edges.filter("dist > 0")
    return edges if max_dist is None else edges.filter(F.col("dist") < max_dist)


def edge_stats(edges: DataFrame, dets: DataFrame, n_classes: int) -> DataFrame:
    """(slide_id, i, j, mean, std, n) for each pair of classes i <= j; null, null and 0 for pairs without edges."""
    pairs = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(n_classes) for j in range(i, n_classes)))
    every = dets.select("slide_id").distinct().select("slide_id", F.inline(pairs))
    found = edges.groupBy("slide_id", "i", "j").agg(F.avg("dist").alias("mean"), F.stddev_samp("dist").alias("std"), F.count("*").alias("n"))
    return every.join(found, ["slide_id", "i", "j"], "left").fillna(0, ["n"])
