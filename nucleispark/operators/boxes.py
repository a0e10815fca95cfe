"""Projections and filters on detections: columns slide_id, nucleus_id, x0, y0, x1, y1, label, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nucleispark.functions.scalars import half_even, next_multiple

CORNERS = ("x0", "y0", "x1", "y1")


def filter_labels(dets: DataFrame, n_classes: int | None = None) -> DataFrame:
    """Labels 1 to n_classes; by default up to the greatest label (no cut above)."""
    kept = dets.filter(F.col("label") >= 1)
    return kept if n_classes is None else kept.filter(F.col("label") <= n_classes)


def filter_scores(dets: DataFrame, threshold: float) -> DataFrame:
    return dets.filter(F.col("score") >= threshold) if threshold > 0 else dets


def keep_where(dets: DataFrame, condition: Column) -> DataFrame:
    """Rows that a caller's predicate holds for."""
    return dets.filter(condition)


def rescale_mpp(dets: DataFrame, slides: DataFrame, target: float = 0.25) -> DataFrame:
    """Boxes at the target resolution, with the slide's h and w there, rounded up. Slides without mpp stay as they are."""
    scale = F.coalesce(F.col("mpp") / target, F.lit(1.0))
    own = slides.select("slide_id", scale.alias("scale"), F.ceil(F.col("h") * scale).alias("h"), F.ceil(F.col("w") * scale).alias("w"))
    return dets.join(own, "slide_id").select(*(c if c not in CORNERS else (F.col(c) * F.col("scale")).alias(c) for c in dets.columns), "h", "w")


def tile_to_slide(dets: DataFrame, tiles: DataFrame, closed_left: bool = False) -> DataFrame:
    """Boxes of padded tiles in slide coordinates, each nucleus once: those whose centre is strictly inside the unpadded tile.

    dets: boxes relative to the padded window, with slide_id, tile_col, tile_row. tiles: x, y, w, h, pad_l, pad_u.
    Centres exactly on a border are lost, unless closed_left takes the upper and left borders in.
    """
    t = tiles.select("slide_id", "tile_col", "tile_row", "x", "y", "w", "h", "pad_l", "pad_u")
    xc, yc = (F.col("x0") + F.col("x1")) / 2 - F.col("pad_l"), (F.col("y0") + F.col("y1")) / 2 - F.col("pad_u")
    above = (xc >= 0) & (yc >= 0) if closed_left else (xc > 0) & (yc > 0)
    shift = {"x0": ("x", "pad_l"), "x1": ("x", "pad_l"), "y0": ("y", "pad_u"), "y1": ("y", "pad_u")}
    moved = [(F.col(c) + F.col(shift[c][0]) - F.col(shift[c][1])).alias(c) if c in shift else F.col(c) for c in dets.columns]
    return dets.join(t, ["slide_id", "tile_col", "tile_row"]).filter(above & (xc < F.col("w")) & (yc < F.col("h"))).select(*moved)


def patch_to_image(dets: DataFrame, patches: DataFrame, multiple: int = 64) -> DataFrame:
    """Boxes of centre-padded, scaled patches in the image's coordinates. patches: slide_id, h, w (after scaling), scale."""
    pad = lambda side: F.floor((next_multiple(F.col(side), multiple) - F.col(side)) / 2)
    own = patches.select("slide_id", "scale", pad("h").alias("pad_u"), pad("w").alias("pad_l"))
    back = {"x0": "pad_l", "x1": "pad_l", "y0": "pad_u", "y1": "pad_u"}
    return dets.join(own, "slide_id").select(*(((F.col(c) - F.col(back[c])) / F.col("scale")).alias(c) if c in back else F.col(c) for c in dets.columns))


def box_columns(dets: DataFrame, rounded: bool = False) -> DataFrame:
    """Adds x_c, y_c, box_w, box_h, box_side (square root of the area) and box_area, which counts both border pixels."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    if rounded:
        rw, rh = half_even(F.col("x1")) - half_even(F.col("x0")), half_even(F.col("y1")) - half_even(F.col("y0"))
        area = F.greatest(rw + 1, F.lit(1.0)) * F.greatest(rh + 1, F.lit(1.0))
    else:
        area = (w + 1) * (h + 1)
    new = {"x_c": (F.col("x0") + F.col("x1")) / 2, "y_c": (F.col("y0") + F.col("y1")) / 2, "box_w": w, "box_h": h, "box_side": F.sqrt(w * h), "box_area": area}
    return dets.withColumns(new)


_FORMATS = {
    "xyxy": ("x0", "y0", "x1", "y1"), "yxyx": ("y0", "x0", "y1", "x1"), "xywh": ("x0", "y0", "w", "h"), "cxcywh": ("xc", "yc", "w", "h"),
}


def convert_box(boxes: DataFrame, source: str, target: str) -> DataFrame:
    """Replaces the four columns of one format by those of another: xyxy, yxyx, xywh or cxcywh."""
    a = {c: F.col(c) for c in _FORMATS[source]}
    if "xc" in a:
        a |= {"x0": a["xc"] - a["w"] / 2, "y0": a["yc"] - a["h"] / 2}
    w, h = a.get("w", None), a.get("h", None)
    x1, y1 = (a["x0"] + w, a["y0"] + h) if w is not None else (a["x1"], a["y1"])
    every = {"x0": a["x0"], "y0": a["y0"], "x1": x1, "y1": y1, "w": x1 - a["x0"], "h": y1 - a["y0"], "xc": (a["x0"] + x1) / 2, "yc": (a["y0"] + y1) / 2}
    rest = [c for c in boxes.columns if c not in _FORMATS[source]]
    return boxes.select(*rest, *(every[c].alias(c) for c in _FORMATS[target]))


def clip_boxes(dets: DataFrame, slides: DataFrame) -> DataFrame:
    """Half-even integer boxes inside the slide; without unlabelled and empty ones."""
    inside = lambda c, side: F.greatest(F.lit(0), F.least(half_even(F.col(c)).cast("int"), F.col(side).cast("int")))
    own = slides.select("slide_id", F.col("h").alias("_h"), F.col("w").alias("_w"))
    cut = dets.filter("label > 0").join(own, "slide_id")
    cut = cut.select(*(inside(c, "_w" if c[0] == "x" else "_h").alias(c) if c in CORNERS else F.col(c) for c in dets.columns))
    return cut.filter("x0 < x1 and y0 < y1")


def label_color(dets: DataFrame, classes: DataFrame, alpha: float = 1.0, outlier: str = "#646464") -> DataFrame:
    """Adds r, g, b (0 to 255) and a. classes: label, color `#rrggbb`, one row for each class."""
    hexa = F.coalesce("color", F.lit(outlier))
    channel = lambda i: F.conv(F.substring(hexa, i, 2), 16, 10).cast("int")
    joined = dets.join(F.broadcast(classes.select("label", "color")), "label", "left")
    return joined.select(*dets.columns, channel(2).alias("r"), channel(4).alias("g"), channel(6).alias("b"), F.lit(alpha).alias("a"))


def fetch_tile(stored: DataFrame, slide_id: object, key: str) -> DataFrame:
    """Rows of one tile of the stored detections; the slide's partition alone is read."""
    return stored.filter((F.col("slide_id") == slide_id) & (F.col("tile_key") == key))
