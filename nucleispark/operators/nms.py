"""Non-maximum suppression: by group in one pass, or over whole slides in rounds."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.operators.batches import begins, deal, whole_groups
from nucleispark.session import checkpointed


def iou(a: str = "a", b: str = "b") -> Column:
    """Intersection over union of two structs with x0, y0, x1, y1."""
    c = lambda s, n: F.col(f"{s}.{n}")
    w = F.greatest(F.least(c(a, "x1"), c(b, "x1")) - F.greatest(c(a, "x0"), c(b, "x0")), F.lit(0.0))
    h = F.greatest(F.least(c(a, "y1"), c(b, "y1")) - F.greatest(c(a, "y0"), c(b, "y0")), F.lit(0.0))
    area = lambda s: (c(s, "x1") - c(s, "x0")) * (c(s, "y1") - c(s, "y0"))
    return w * h / F.nullif(area(a) + area(b) - w * h, F.lit(0.0))


def nms_by_group(dets: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Greedy NMS inside each group (a tile): by score, then nucleus_id, a box goes if its IoU with a kept one is over the threshold.
    Rows dealt and sorted by group are read in batches of many groups."""

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        group = np.cumsum(np.append(False, (pdf[keys].iloc[1:].to_numpy() != pdf[keys].iloc[:-1].to_numpy()).any(axis=1)))
        order = np.lexsort((pdf["nucleus_id"].to_numpy(), -pdf["score"].to_numpy(float), group))
        x0, y0, x1, y1 = (pdf[c].to_numpy(float)[order] for c in ("x0", "y0", "x1", "y1"))
        area, kept = (x1 - x0) * (y1 - y0), []
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pdf)], strict=True):
            alive = np.ones(hi - lo, bool)
            for i in range(lo, hi):
                if not alive[i - lo]:
                    continue
                kept.append(i)
                w = np.maximum(np.minimum(x1[i], x1[lo:hi]) - np.maximum(x0[i], x0[lo:hi]), 0)
                h = np.maximum(np.minimum(y1[i], y1[lo:hi]) - np.maximum(y0[i], y0[lo:hi]), 0)
                with np.errstate(invalid="ignore", divide="ignore"):
                    alive &= ~(w * h / (area[i] + area[lo:hi] - w * h) > threshold)
        return pdf.iloc[order[kept]]

    return deal(dets, *keys).sortWithinPartitions(*keys).mapInPandas(whole_groups(keys, greedy), dets.schema)


def _overlaps(dets: DataFrame, threshold: float, bin_size: int) -> DataFrame:
    """(slide_id, a, b): boxes as structs whose IoU is over the threshold, the better one as a, each pair once.

    Boxes are listed under all grid bins that they touch; a pair counts in the bin of its intersection's corner only.
    """
    bins = lambda a, b: F.sequence(F.floor(F.col(a) / bin_size), F.floor(F.col(b) / bin_size))
    box = F.struct("x0", "y0", "x1", "y1", "score", "nucleus_id")
    spread = dets.select("slide_id", box.alias("box"), F.explode(bins("x0", "x1")).alias("bx"), bins("y0", "y1").alias("by")).withColumn("by", F.explode("by"))
    both = spread.withColumnRenamed("box", "a").join(spread.withColumnRenamed("box", "b"), ["slide_id", "bx", "by"])
    first = (F.col("a.score") > F.col("b.score")) | (F.col("a.score") == F.col("b.score")) & (F.col("a.nucleus_id") < F.col("b.nucleus_id"))
    corner = (F.floor(F.greatest("a.x0", "b.x0") / bin_size) == F.col("bx")) & (F.floor(F.greatest("a.y0", "b.y0") / bin_size) == F.col("by"))
    return both.filter(first & corner & (iou() > threshold)).select("slide_id", "a", "b")


def overlapping_pairs(dets: DataFrame, threshold: float, bin_size: int) -> DataFrame:
    """(slide_id, better, worse): nucleus ids of boxes whose IoU is over the threshold, each pair once."""
    return _overlaps(dets, threshold, bin_size).select("slide_id", F.col("a.nucleus_id").alias("better"), F.col("b.nucleus_id").alias("worse"))


def _decide(worse: np.ndarray, score: np.ndarray, better: np.ndarray, foreign: np.ndarray, status: np.ndarray) -> dict[int, int]:
    """1 kept, 2 dropped or 0 for each box of `worse`, in the order of scores: from pairs with better boxes, whose status is known (foreign
    ones) or decided before."""
    order = np.lexsort((worse, -score))
    worse, better, foreign, status = (x[order].tolist() for x in (worse, better, foreign, status))
    found = dict.fromkeys(worse, 0)
    i = 0
    while i < len(worse):
        j, kept, open_ones = i, False, False
        while j < len(worse) and worse[j] == worse[i]:
            s = status[j] if foreign[j] else found.get(better[j], 1)  # a box here that nothing overlaps stays
            kept |= s == 1
            open_ones |= s == 0
            j += 1
        found[worse[i]] = 2 if kept else 0 if open_ones else 1
        i = j
    return found


def suppress_slides(dets: DataFrame, threshold: float, bin_size: int = 64, block: int = 2048) -> tuple[DataFrame, int]:
    """Greedy NMS over whole slides, the same result as one pass by score, and how many rounds it took.

    A slide is cut into blocks, and a pair of overlapping boxes belongs to the worse one's block. A task decides all boxes of its block whose
    better overlaps are decided; what waits for a box of another block goes on to the next round with that box's status.
    Rounds go with the block borders that a chain of overlaps crosses, not with its length. nucleus_id tells a slide's boxes apart.
    """
    at = lambda s: (F.floor((F.col(f"{s}.x0") + F.col(f"{s}.x1")) / (2 * block)).cast("long"), F.floor((F.col(f"{s}.y0") + F.col(f"{s}.y1")) / (2 * block)).cast("long"))
    (ax, ay), (bx, by) = at("a"), at("b")
    pairs = _overlaps(dets, threshold, bin_size).select("slide_id", bx.alias("cx"), by.alias("cy"), F.col("b.nucleus_id").alias("worse"), F.col("b.score").alias("score"), F.col("a.nucleus_id").alias("better"), ((ax != bx) | (ay != by)).alias("foreign"))
    pairs = checkpointed(pairs)
    ids = pairs.select("slide_id", F.col("worse").alias("better")).distinct().withColumn("_w", F.lit(1))
    free = F.when(F.col("foreign") & F.col("_w").isNull(), 1).otherwise(0)
    waiting = pairs.join(ids, ["slide_id", "better"], "left").withColumn("status", free).drop("_w")
    kind = {c: dets.schema[c].dataType.simpleString() for c in ("slide_id", "nucleus_id")}
    schema = f"slide_id {kind['slide_id']}, cx long, cy long, worse {kind['nucleus_id']}, score double, better {kind['nucleus_id']}, foreign boolean, status int"

    names = ["slide_id", "cx", "cy"]

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of whole blocks, sorted."""
        starts = begins(pdf, names)
        worse, score, better, foreign, status = (pdf[c].to_numpy() for c in ("worse", "score", "better", "foreign", "status"))
        mine, known = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        first = np.zeros(len(pdf), bool)
        for lo, hi in zip(starts, np.append(starts[1:], len(pdf)), strict=True):
            own = slice(lo, hi)
            found = _decide(worse[own], score[own], better[own], foreign[own], status[own])
            mine[own] = [found[w] for w in worse[own].tolist()]
            known[own] = [s if f else found.get(b, 1) for b, f, s in zip(better[own].tolist(), foreign[own].tolist(), status[own].tolist(), strict=True)]
            first[lo + np.unique(worse[own], return_index=True)[1]] = True
        out = pdf.assign(status=mine)
        out["better"] = np.where(mine > 0, worse, better)
        return out[(mine > 0) & first | (mine == 0) & (known == 0)]

    dropped, rounds = [], 0
    columns = [c.split()[0] for c in schema.split(", ")]
    while not waiting.isEmpty():
        rounds += 1
        made = checkpointed(deal(waiting.select(*columns), *names).sortWithinPartitions(*names).mapInPandas(whole_groups(names, some), schema))
        decided = made.filter("status > 0").select("slide_id", F.col("worse").alias("better"), F.col("status").alias("_s"))
        dropped.append(decided.filter("_s = 2").select("slide_id", F.col("better").alias("nucleus_id")))
        waiting = made.filter("status = 0").join(decided, ["slide_id", "better"], "left").withColumn("status", F.coalesce("_s", F.lit(0))).drop("_s")
    if dropped:  # in one join, since all boxes take part in each
        dets = dets.join(reduce(DataFrame.unionAll, dropped), ["slide_id", "nucleus_id"], "left_anti")
    return dets, rounds


def nms_by_slide(dets: DataFrame, threshold: float, bin_size: int = 64, block: int = 2048) -> DataFrame:
    """The boxes that suppress_slides keeps."""
    return suppress_slides(dets, threshold, bin_size, block)[0]


def top_by_score(dets: DataFrame, keys: list[str], n: int = 1000) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "nucleus_id")
    return dets.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")
