"""Parts, holes and contours by blocks against the plain kernels on whole masks."""

from __future__ import annotations

import numpy as np
import pytest

from nucleispark.kernels import components, contour
from nucleispark.operators import regions, roi

SHAPES = {0: (23, 31), 1: (7, 5), 2: (40, 9), 3: (1, 12), 4: (16, 16), 5: (9, 9)}


def masks() -> dict[int, np.ndarray]:
    rng = np.random.default_rng(3)
    out = {i: rng.random(s) < p for (i, s), p in zip(SHAPES.items(), (0.6, 0.5, 0.7, 0.5, 0.55, 1.1), strict=True)}
    spiral = np.zeros((24, 24), bool)  # one long part that runs over many blocks, a hole of many blocks with an island
    spiral[2, 2:22] = spiral[21, 2:22] = spiral[2:22, 2] = spiral[2:22, 21] = True
    spiral[10:13, 10:13] = True
    snake = np.zeros((24, 24), bool)
    snake[::2] = True
    snake[1::4, -1] = snake[3::4, 0] = True
    ring = np.ones((30, 30), bool)
    ring[1:29, 1:29] = False
    ring[5, 0] = False  # a way out
    return out | {6: spiral, 7: snake, 8: ring, 9: np.zeros((20, 20), bool), 10: ~ring}


def tables(spark, found):
    cells = spark.createDataFrame([(k, int(r), int(c)) for k, m in found.items() for r, c in zip(*np.nonzero(m))], "slide_id long, gr int, gc int")
    return cells, spark.createDataFrame([(k, *m.shape) for k, m in found.items()], "slide_id long, gh int, gw int")


@pytest.mark.parametrize("block", [5, 64])
def test_parts_and_holes_by_blocks(spark, block):
    found = masks()
    cells, sizes = tables(spark, found)
    odd = cells.unionByName(spark.createDataFrame([(0, 0, 500), (0, -3, 2), (99, 1, 1)], cells.schema)).unionByName(cells)  # outside, of no slide, repeated
    got = regions.run_cells(regions.filled_runs(odd, sizes, 0.0, block)).collect()
    for k, m in found.items():
        numbers, _ = components.label(components.fill_holes(m))
        image = np.zeros(m.shape, int)
        for r in got:
            if r["slide_id"] == k:
                assert image[r["gr"], r["gc"]] == 0
                image[r["gr"], r["gc"]] = r["component"]
        assert (image == numbers).all(), k


def test_small_parts_go(spark):
    found = {k: m for k, m in masks().items() if k < 3}
    cells, sizes = tables(spark, found)
    got = roi.fill_and_label(cells, sizes, 0.05, 6).collect()
    for k, m in found.items():
        kept = components.remove_small(components.fill_holes(m), 0.05 * m.size)
        assert {(r["gr"], r["gc"]) for r in got if r["slide_id"] == k} == set(zip(*map(np.ndarray.tolist, np.nonzero(kept)))), k
    assert roi.fill_and_label(cells.filter("gr > 99"), sizes).count() == 0


@pytest.mark.parametrize("block", [6])
def test_contours_by_blocks(spark, block):
    found = masks()
    cells, sizes = tables(spark, found)
    got = regions.contours(cells, sizes, 2.0, 0.0, block).orderBy("slide_id", "ring").collect()
    for k, m in found.items():
        rings = contour.contours(m)
        mine = [r for r in got if r["slide_id"] == k]
        assert [[(p["y"], p["x"]) for p in r["vertices"]] for r in mine] == [[(2 * y, 2 * x) for y, x in ring.tolist()] for ring in rings], k
        assert np.allclose([r["area"] for r in mine], [4 * contour.area(r) for r in rings])


def test_contours_enclose_the_quads_area(spark):
    """Outer contours of masks without holes hold what the quads add up to, and small rings go by their share."""
    found = {k: components.fill_holes(m) for k, m in masks().items() if k != 9}
    cells, sizes = tables(spark, found)
    area = {r[0]: r[1] for r in roi.roi_area(cells, sizes, 3).collect()}
    summed: dict[int, float] = {}
    rings = roi.roi_polygons(cells, sizes, 3, 0.0).collect()
    for r in rings:
        summed[r["slide_id"]] = summed.get(r["slide_id"], 0) + r["area"]
    assert {k: a for k, a in summed.items() if a} == pytest.approx({k: a for k, a in area.items() if a})
    big = roi.roi_polygons(cells, sizes, 3, 0.2).collect()
    assert {(r["slide_id"], r["area"]) for r in big} == {(r["slide_id"], r["area"]) for r in rings if area.get(r["slide_id"]) and r["area"] >= 0.2 * area[r["slide_id"]]}
