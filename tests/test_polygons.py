"""Points in polygons by bands, and exact sampling."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nucleispark.kernels import ears
from nucleispark.operators import masks, roi

RING = "slide_id long, poly_id int, vertices array<struct<x:double,y:double>>"


def listed(p) -> list[dict[str, float]]:
    return [{"x": float(x), "y": float(y)} for x, y in p]


def star(n: int, seed: int) -> np.ndarray:
    """A simple polygon with reflex corners."""
    rng = np.random.default_rng(seed)
    angle = np.sort(rng.uniform(0, 2 * math.pi, n))
    far = rng.uniform(5, 60, n)
    return np.stack([100 + far * np.cos(angle), 90 + far * np.sin(angle)], 1)


def area(p: np.ndarray) -> float:
    x, y = p.T
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def holds(rings: list[np.ndarray], x: float, y: float) -> bool:
    odd = False
    for p in rings:
        for (a, b), (c, d) in zip(p, np.roll(p, -1, axis=0)):
            odd ^= bool((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a)
    return odd


@pytest.mark.parametrize("bin_size", [7, 64, 1000])
def test_points_in_polygons_by_bands(spark, bin_size):
    rng = np.random.default_rng(bin_size)
    shapes = {1: [star(40, 1)], 2: [np.array([(10, 10), (190, 10), (190, 170), (10, 170)], float), np.array([(60, 60), (140, 60), (140, 120), (60, 120)], float)], 3: [np.array([(-30, -20), (40, 50), (40, -20), (-30, 50)], float)]}
    polygons = spark.createDataFrame([(1, k, listed(p)) for k, rings in shapes.items() for p in rings] + [(1, 8, []), (1, 9, None), (2, 1, listed(star(5, 2)))], RING)
    points = np.concatenate([rng.uniform(-40, 220, (250, 2)), rng.integers(-5, 25, (60, 2)) * 10.0])
    rows = [(1, i, float(x), float(y)) for i, (x, y) in enumerate(points)] + [(1, 0, float(points[0][0]), float(points[0][1]))]
    got = sorted((r["k"], r["poly_id"]) for r in roi.points_in_polygons(spark.createDataFrame(rows, "slide_id long, k int, x double, y double"), polygons, bin_size).collect())
    assert got == sorted((k, q) for _, k, x, y in rows for q, rings in shapes.items() if holds(rings, x, y))


def test_triangles_make_up_their_polygon():
    for seed in range(12):
        p = star(5 + 3 * seed, seed)
        for q in (p, p[::-1], np.concatenate([p, p[:1]]), np.repeat(p, 2, axis=0)):
            t = ears.triangles(q)
            assert len(t) == len(p) - 2 and sum(map(area, t)) == pytest.approx(area(p))
            assert all(holds([p], *tri.mean(0)) for tri in t if area(tri) > 1e-6)
    assert sum(map(area, ears.triangles(np.array([(0, 0), (1, 0), (2, 0), (2, 2), (0, 2)])))) == 4
    assert len(ears.triangles(np.array([(0, 0), (3, 0)]))) == len(ears.triangles(np.zeros((0, 2)))) == 0
    with pytest.raises(ValueError, match="crosses"):
        ears.triangles(np.array([(0, 0), (4, 4), (4, 0), (0, 4)], float))


def test_exactly_n_points_by_area(spark):
    shapes = {(1, 1): star(30, 5), (1, 2): star(9, 6) + 300, (1, 3): np.array([(0, 500), (40, 500), (40, 530), (0, 530)], float), (2, 1): star(12, 7)}
    polygons = spark.createDataFrame([(s, k, listed(p)) for (s, k), p in shapes.items()] + [(3, 1, listed([(0, 0), (5, 5), (9, 9)])), (4, 1, None)], RING)
    n = 3000
    points = roi.sample_in_polygons(polygons, n).collect()
    assert sorted((p["slide_id"], p["k"]) for p in points) == [(s, k) for s in (1, 2) for k in range(1, n + 1)]
    assert all(holds([shapes[p["slide_id"], p["poly_id"]]], p["x"], p["y"]) for p in points)
    whole = sum(area(p) for (s, _), p in shapes.items() if s == 1)
    expected = {k: n * area(p) / whole for (s, k), p in shapes.items() if s == 1}
    found = {k: sum(p["slide_id"] == 1 and p["poly_id"] == k for p in points) for k in expected}
    assert sum((found[k] - e) ** 2 / e for k, e in expected.items()) < 13.8  # chi-square, 2 degrees, one in a thousand
    square = [p for p in points if p["poly_id"] == 3]
    cells = np.histogram2d([p["x"] for p in square], [p["y"] - 500 for p in square], bins=[4, 3], range=[[0, 40], [0, 30]])[0].ravel()
    assert ((cells - cells.mean()) ** 2 / cells.mean()).sum() < 31.3  # 11 degrees
    again = roi.sample_in_polygons(polygons.repartition(3), n).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, points))
    assert roi.sample_in_polygons(polygons, n, seed=7).agg(F.count("*")).first()[0] == 2 * n


def test_annotation_rows_are_parsed_once(spark):
    square = [{"x": float(x), "y": float(y)} for x, y in ((2, 3), (6, 3), (6, 8), (2, 8))]
    polygons = spark.createDataFrame([(1, 9, 2, square), (2, 9, 3, square[:1])], "id long, image_id long, label int, vertices array<struct<x:double,y:double>>")
    crowd = '{"id": 3, "image_id": 9, "category_id": 1, "segmentation": [[1.0, 2.0, 3.0, 4.0]], "iscrowd": %s}'
    rows = masks.to_coco_polygons(polygons).unionByName(spark.createDataFrame([(3, crowd % 1), (4, crowd % "null")], "id long, json string"))
    assert [(r["id"], r["label"], [(p["x"], p["y"]) for p in r["vertices"]]) for r in masks.from_coco_polygons(rows).orderBy("id").collect()] == [(1, 2, [(2, 3), (6, 3), (6, 8), (2, 8)]), (2, 3, [(2, 3)])]
    plan = masks.from_coco_polygons(masks.to_coco_polygons(polygons))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1, plan
