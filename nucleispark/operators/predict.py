"""Tile scoring with a caller's detector."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from nucleispark.operators.batches import deal
from nucleispark.operators.boxes import filter_scores, tile_to_slide
from nucleispark.operators.nms import nms_by_group, top_by_score

DETECTED = "slide_id long, tile_col int, tile_row int, nucleus_id long, x0 double, y0 double, x1 double, y1 double, label int, score double"


def score_tiles(tiles: DataFrame, make_detector: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], partitions: int | None = None) -> DataFrame:
    """Detections of a detector that each Python worker makes once and calls with batches of tiles; it returns the columns of DETECTED, boxes
    relative to the padded window. Tiles are spread evenly over partitions by their key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = make_detector()
        for pdf in batches:
            yield detect(pdf)

    key = ["slide_id", "tile_col", "tile_row"]
    spread = tiles.repartition(partitions, *key) if partitions else deal(tiles, *key)
    return spread.mapInPandas(run, DETECTED)


def detect_slides(tiles: DataFrame, make_detector: Callable, score: float = 0.0, iou: float = 0.5, most: int = 1000) -> DataFrame:
    """Scored, suppressed by tile, the best of each tile, and each nucleus once in slide coordinates."""
    key = ["slide_id", "tile_col", "tile_row"]
    found = filter_scores(score_tiles(tiles, make_detector), score)
    return tile_to_slide(top_by_score(nms_by_group(found, key, iou), key, most), tiles)
