"""Annotated regions (slide_id, region_id, label, vertices) and the choice of a region of interest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_annotations(annotations: DataFrame, pattern: str) -> DataFrame:
    """Regions whose label matches the pattern from its start on."""
    return annotations.filter(F.col("label").rlike(f"^(?:{pattern})"))


def roi_regions(annotations: DataFrame, mode: str | DataFrame | Callable[[DataFrame], DataFrame], tissue: DataFrame | None = None) -> DataFrame | None:
    """The regions of a mode: `all` none (the whole slide), `xml` every annotated one, `tissue` the given tissue regions, else a label
    pattern; or the caller's own: regions (polygons or cells of a mask), or a function that picks them from the annotations."""
    if isinstance(mode, DataFrame):
        return mode
    if callable(mode):
        return mode(annotations)
    if mode == "all":
        return None
    if mode == "xml":
        return annotations
    if mode == "tissue":
        if tissue is None:
            raise ValueError("mode tissue needs tissue regions")
        return tissue
    return filter_annotations(annotations, mode)
