"""Point clouds, pooled densities, kernel smoothing and class products. Everything is sparse rows; nothing is made dense but blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.functions.scalars import half_even
from nucleispark.kernels.conv import density_kernel, spread
from nucleispark.operators.batches import begins, deal, whole_groups

#: Cells a side of a smoothing block.
BLOCK = 64


def nuclei_map(dets: DataFrame, use_scores: bool = False) -> DataFrame:
    """(slide_id, cls, row, col, val): nuclei of a class on one pixel are one row whose val is their number or summed score."""
    row, col = half_even((F.col("y0") + F.col("y1")) / 2), half_even((F.col("x0") + F.col("x1")) / 2)
    points = dets.select("slide_id", (F.col("label") - 1).alias("cls"), row.cast("int").alias("row"), col.cast("int").alias("col"), F.col("score").alias("s"))
    return points.groupBy("slide_id", "cls", "row", "col").agg((F.sum("s") if use_scores else F.count("*").cast("double")).alias("val"))


def slide_extent(dets: DataFrame) -> DataFrame:
    """(slide_id, h, w) where sizes are unknown."""
    side = lambda a, b: (F.ceil(F.max(F.greatest(a, b))) + 1).cast("int")
    return dets.groupBy("slide_id").agg(side("y0", "y1").alias("h"), side("x0", "x1").alias("w"))


def pool_density(cells: DataFrame, slides: DataFrame, divisor: int, grid: int = 4096) -> DataFrame:
    """(slide_id, cls, gr, gc, d): averages over bins at 1/divisor of the slide; cells of zero are absent.

    Of n pixels pooled to m bins, bin i is [floor(i n / m), ceil((i + 1) n / m)); bins overlap where m doesn't divide n. Slides
    with a side of `grid` or more are pooled in blocks of `grid` pixels, cut to the size that the whole slide has.
    """
    big = (F.col("h") >= grid) | (F.col("w") >= grid)
    span = lambda c: F.when(big, F.lit(grid)).otherwise(F.col(c).cast("int"))
    small = lambda c: F.rint(span(c) / divisor).cast("int")
    own = slides.select("slide_id", span("h").alias("bh"), span("w").alias("bw"), small("h").alias("mh"), small("w").alias("mw"), F.rint(F.col("h") / divisor).cast("int").alias("gh"), F.rint(F.col("w") / divisor).cast("int").alias("gw"))
    rows = cells.join(own, "slide_id")

    def bins(p: str, n: str, m: str):
        """The one or two bins of a pixel within its block, with the length of each bin."""
        at = F.col(p) % F.col(n)
        first, last = F.floor(at * F.col(m) / F.col(n)), F.least(F.ceil((at + 1) * F.col(m) / F.col(n)), F.col(m)) - 1
        return F.explode(F.when((at >= 0) & (first <= last), F.sequence(first, last)))

    def placed(i: str, p: str, n: str, m: str):
        """A bin's place in the slide and its length."""
        begin, end = F.floor(F.col(i) * F.col(n) / F.col(m)), F.ceil((F.col(i) + 1) * F.col(n) / F.col(m))
        return F.struct((F.col(i) + F.floor(F.col(p) / F.col(n)) * F.col(m)).cast("int").alias("g"), (end - begin).alias("len"))

    rows = rows.withColumn("_r", bins("row", "bh", "mh")).withColumn("_c", bins("col", "bw", "mw")).withColumns({"r": placed("_r", "row", "bh", "mh"), "c": placed("_c", "col", "bw", "mw")})
    rows = rows.filter((F.col("r.g") < F.col("gh")) & (F.col("c.g") < F.col("gw")))
    return rows.groupBy("slide_id", "cls", F.col("r.g").alias("gr"), F.col("c.g").alias("gc")).agg(F.sum(F.col("val") / (F.col("r.len") * F.col("c.len"))).alias("d"))


def kernel_rows(spark, kernels: dict[int, np.ndarray]) -> DataFrame:
    """(cls, dr, dc, weight) of given kernels, one for each class: a few hundred rows each."""
    rows = [(k, int(i) - m.shape[0] // 2, int(j) - m.shape[1] // 2, float(m[i, j])) for k, m in kernels.items() for i, j in zip(*np.nonzero(m), strict=True)]
    return spark.createDataFrame(rows, "cls int, dr int, dc int, weight double")


def class_kernels(radius: DataFrame, scale: float, method: str = "gaussian") -> DataFrame:
    """(slide_id, cls, dr, dc, weight): the taps of each class's smoothing kernel, from (slide_id, cls, radius); none for a radius
    that is null or at most 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for slide, cls, r in pdf.itertuples(index=False):
                kernel = density_kernel(float(r), scale, method)
                if kernel is not None:
                    i, j = np.nonzero(kernel)
                    yield pd.DataFrame({"slide_id": slide, "cls": cls, "dr": i - len(kernel) // 2, "dc": j - len(kernel) // 2, "weight": kernel[i, j]})

    kind = radius.schema["slide_id"].dataType.simpleString()
    return radius.filter("radius > 1").select("slide_id", "cls", "radius").mapInPandas(run, f"slide_id {kind}, cls int, dr int, dc int, weight double")


def smooth_by_taps(pooled: DataFrame, kernels: DataFrame, sizes: DataFrame) -> DataFrame:
    """Same-size correlation with zero padding: each cell adds its taps to its neighbours. For kernels of few taps; kernels: (cls, dr,
    dc, weight); sizes: (slide_id, gh, gw). Classes without kernel stay as they are."""
    taps = F.broadcast(kernels)  # by class alone all rows would meet in a few tasks
    spread = pooled.join(taps, "cls").join(sizes, "slide_id")
    moved = spread.select("slide_id", "cls", (F.col("gr") - F.col("dr")).alias("gr"), (F.col("gc") - F.col("dc")).alias("gc"), (F.col("d") * F.col("weight")).alias("d"), "gh", "gw")
    moved = moved.filter("gr >= 0 and gc >= 0 and gr < gh and gc < gw").groupBy("slide_id", "cls", "gr", "gc").agg(F.sum("d").alias("d"))
    same = pooled.join(F.broadcast(kernels.select("cls").distinct()), "cls", "left_anti").select("slide_id", "cls", "gr", "gc", "d")
    return moved.unionByName(same)


def _by_reach(pooled: DataFrame, radius: DataFrame, sizes: DataFrame, scale: float, block: int) -> DataFrame:
    """Cells under each block of the grid, (br, bc), that the kernel of their own class reaches."""
    reach = F.when(F.col("radius") > 1, F.rint(F.col("radius") * (2 * 8 * scale)).cast("int")).otherwise(F.lit(0))
    rows = pooled.join(radius, ["slide_id", "cls"]).join(sizes, "slide_id").withColumn("reach", reach)
    place = lambda c: F.floor(c / block).cast("int")
    blocks = lambda c, n: F.sequence(place(F.greatest(F.col(c) - F.col("reach"), F.lit(0))), place(F.least(F.col(c) + F.col("reach"), F.col(n) - 1)))
    rows = rows.withColumn("br", F.explode(blocks("gr", "gh"))).withColumn("bc", F.explode(blocks("gc", "gw")))
    return rows.select("slide_id", "cls", "br", "bc", "gr", "gc", "d", "radius", "gh", "gw")


def _smoothed(pdf: pd.DataFrame, names: list[str], scale: float, method: str, block: int) -> Iterator[tuple[int, np.ndarray]]:
    """The first row and the smoothed block of each run of rows with equal names, which hold the class."""
    starts = begins(pdf, names)
    gr, gc, d, radii, br, bc = (pdf[c].to_numpy() for c in ("gr", "gc", "d", "radius", "br", "bc"))
    for lo, hi in zip(starts, np.append(starts[1:], len(pdf)), strict=True):
        kernel = density_kernel(None if radii[lo] is None or np.isnan(radii[lo]) else float(radii[lo]), scale, method)
        yield lo, spread(gr[lo:hi] - int(br[lo]) * block, gc[lo:hi] - int(bc[lo]) * block, d[lo:hi], np.ones((1, 1)) if kernel is None else kernel, (block, block))


def smooth_density(pooled: DataFrame, radius: DataFrame, sizes: DataFrame, scale: float, method: str = "gaussian", block: int = BLOCK) -> DataFrame:
    """Smooths each (slide, class) with the kernel of its own radius (slide_id, cls, radius), in blocks with a halo.

    A cell goes to each block of the grid that its kernel reaches, so a block is all that is held at once, whatever the slide's size.
    Classes whose radius is null or at most 1 aren't smoothed. sizes: (slide_id, gh, gw).
    """
    names = ["slide_id", "cls", "br", "bc"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of whole blocks, sorted."""
        found = []
        for lo, out in _smoothed(pdf, names, scale, method, block):
            i, j = np.nonzero(out)
            found.append((np.full(len(i), lo), i + pdf["br"].iat[lo] * block, j + pdf["bc"].iat[lo] * block, out[i, j]))
        at, i, j, values = (np.concatenate(x) for x in zip(*found, strict=True))
        out = {"slide_id": pdf["slide_id"].to_numpy()[at], "cls": pdf["cls"].to_numpy()[at], "gr": i, "gc": j, "d": values}
        return pd.DataFrame(out)[(i < pdf["gh"].to_numpy()[at]) & (j < pdf["gw"].to_numpy()[at])]

    kind = pooled.schema["slide_id"].dataType.simpleString()
    dealt = deal(_by_reach(pooled, radius, sizes, scale, block), *names).sortWithinPartitions(*names, "gr", "gc")
    return dealt.mapInPandas(whole_groups(names, one), f"slide_id {kind}, cls int, gr int, gc int, d double")


def smooth_wide(pooled: DataFrame, radius: DataFrame, sizes: DataFrame, scale: float, n_classes: int, method: str = "gaussian", block: int = BLOCK) -> DataFrame:
    """(slide_id, gr, gc, d0, d1, ...): smooth_density with a column for each class, 0 where only others have a density. A block's classes
    meet in one task, so that no shuffle of cells has to bring them together."""
    names = ["slide_id", "br", "bc"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of whole blocks, sorted."""
        starts = begins(pdf, names)
        images = np.zeros((len(starts), n_classes, block, block))
        for lo, out in _smoothed(pdf, [*names, "cls"], scale, method, block):
            images[np.searchsorted(starts, lo, "right") - 1, pdf["cls"].iat[lo]] = out
        k, i, j = np.nonzero((images != 0).any(axis=1))
        at = starts[k]
        values = images[k, :, i, j]
        gr, gc = i + pdf["br"].to_numpy()[at] * block, j + pdf["bc"].to_numpy()[at] * block
        out = pd.DataFrame({"slide_id": pdf["slide_id"].to_numpy()[at], "gr": gr, "gc": gc, **{f"d{c}": values[:, c] for c in range(n_classes)}})
        return out[(gr < pdf["gh"].to_numpy()[at]) & (gc < pdf["gw"].to_numpy()[at])]

    kind = pooled.schema["slide_id"].dataType.simpleString()
    near = _by_reach(pooled.filter(F.col("cls").between(0, n_classes - 1)), radius, sizes, scale, block)
    dealt = deal(near, *names).sortWithinPartitions(*names, "cls", "gr", "gc")
    return dealt.mapInPandas(whole_groups(names, one), f"slide_id {kind}, gr int, gc int" + "".join(f", d{c} double" for c in range(n_classes)))


def dot_products(density: DataFrame, n_classes: int) -> DataFrame:
    """(slide_id, i, j, dot), i <= j: sums over cells of products of class densities, 0 where two classes never meet."""
    classes = range(n_classes)
    wide = density.groupBy("slide_id", "gr", "gc").agg(*(F.coalesce(F.sum(F.when(F.col("cls") == c, F.col("d"))), F.lit(0.0)).alias(f"d{c}") for c in classes))
    return wide_products(wide, n_classes)


def wide_products(wide: DataFrame, n_classes: int) -> DataFrame:
    """The same from cells with a column for each class, (slide_id, gr, gc, d0, d1, ...)."""
    pairs = [(i, j) for i in range(n_classes) for j in range(i, n_classes)]
    sums = wide.groupBy("slide_id").agg(*(F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"p{i}_{j}") for i, j in pairs))
    return sums.select("slide_id", F.inline(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"p{i}_{j}").alias("dot")) for i, j in pairs))))


def scatter_cells(cells: DataFrame, colors: DataFrame, divisor: int) -> DataFrame:
    """(slide_id, gr, gc, r, g, b): channels are 1 in pooled cells with a point of a class whose colour has them. colors: (cls, r, g, b)."""
    own = cells.join(F.broadcast(colors), "cls").groupBy("slide_id", F.floor(F.col("row") / divisor).alias("gr"), F.floor(F.col("col") / divisor).alias("gc"))
    return own.agg(*((F.max(F.col(c)) > 0).cast("int").alias(c) for c in "rgb"))


def density_image(density: DataFrame, divisor: int) -> DataFrame:
    """(slide_id, gr, gc, r, g, b): classes 1, 0 and 2 as channels, times 3 * divisor, cut to 0..1."""
    channel = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.sum(F.when(F.col("cls") == c, F.col("d"))), F.lit(0.0)) * divisor * 3))
    return density.filter("cls in (0, 1, 2)").groupBy("slide_id", "gr", "gc").agg(channel(1).alias("r"), channel(0).alias("g"), channel(2).alias("b"))


def pooled_sizes(slides: DataFrame, divisor: int) -> DataFrame:
    return slides.select("slide_id", F.rint(F.col("h") / divisor).cast("int").alias("gh"), F.rint(F.col("w") / divisor).cast("int").alias("gw"))


