"""The steps of the whole record: many groups in a call, wide smoothing, points in runs, and each step worked out once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from nucleispark.kernels import conv
from nucleispark.operators import batches, density, regions, roi, summary


def test_groups_come_whole_and_many_at_a_time():
    rows = pd.DataFrame({"g": np.repeat(np.arange(50), 7), "k": ["a"] * 175 + [None] * 175, "v": range(350)})
    calls = []
    run = batches.whole_groups(["g", "k"], lambda pdf: calls.append(pdf) or pdf, 40)
    out = pd.concat(run(rows.iloc[i : i + 3] for i in range(0, 350, 3)))
    assert out["v"].tolist() == list(range(350)) and len(calls) < 12
    assert sum(c["g"].nunique() for c in calls) == 50 and all((c.groupby("g").size() == 7).all() for c in calls)
    one = batches.whole_groups(["g"], lambda pdf: calls.append(pdf) or pdf, 5)
    assert sum(1 for _ in one(rows.assign(g=1).iloc[i : i + 3] for i in range(0, 350, 3))) == 1


def test_dense_and_sparse_spreading_agree():
    rng = np.random.default_rng(3)
    kernel = conv.density_kernel(15.0, 1 / 32) * np.linspace(1, 2, 17) * np.linspace(1, 3, 17)[:, None]
    rows, cols, values = rng.integers(-8, 48, 900), rng.integers(-8, 30, 900), rng.random(900)
    few, many = (np.zeros((40, 22)) for _ in range(2))
    for lo in range(0, 900, 5):
        few += conv.spread(rows[lo : lo + 5], cols[lo : lo + 5], values[lo : lo + 5], kernel, (40, 22))
    many += conv.spread(rows, cols, values, kernel, (40, 22))
    assert np.allclose(few, many, rtol=1e-12) and np.allclose(many, conv._dense(rows, cols, values, kernel, (40, 22)), rtol=1e-12)


def test_wide_smoothing_is_smoothing(spark):
    rng = np.random.default_rng(5)
    cells = [(s, int(c), int(r), int(q), 1.0) for s in (1, 2) for c, r, q in zip(rng.integers(0, 3, 300), rng.integers(0, 150, 300), rng.integers(0, 70, 300), strict=True)]
    pooled = spark.createDataFrame(cells, "slide_id long, cls int, gr int, gc int, d double").groupBy("slide_id", "cls", "gr", "gc").agg(F.sum("d").alias("d"))
    radius = spark.createDataFrame([(s, c, r) for s in (1, 2) for c, r in ((0, 15.0), (1, None), (2, 4.0 * s))], "slide_id long, cls int, radius double")
    sizes = spark.createDataFrame([(1, 150, 70), (2, 150, 70)], "slide_id long, gh int, gw int")
    plain = {(r["slide_id"], r["cls"], r["gr"], r["gc"]): r["d"] for r in density.smooth_density(pooled, radius, sizes, 1 / 32).collect()}
    wide = {(r["slide_id"], c, r["gr"], r["gc"]): r[f"d{c}"] for r in density.smooth_wide(pooled, radius, sizes, 1 / 32, 3).collect() for c in range(3) if r[f"d{c}"]}
    assert plain.keys() == wide.keys() and all(abs(plain[k] - wide[k]) < 1e-12 for k in plain)


def test_points_in_runs_are_those_in_cells(spark):
    runs = spark.createDataFrame([(1, 0, 2, 5), (1, 0, 8, 8), (1, 3, 0, 30), (2, 7, 1, 1)], "slide_id long, gr int, c0 int, c1 int").withColumn("component", F.lit(1))
    points = lambda rows: sorted(tuple(r) for r in rows.select("slide_id", "k", "x", "y").collect())
    assert points(roi.sample_in_runs(runs, 40, 32)) == points(roi.sample_in_cells(regions.run_cells(runs), 40, 32))


def test_the_record_finds_its_patches_once(spark, monkeypatch):
    """What the features are read from is stored: their plan has no join with patches left."""
    dets = spark.createDataFrame([(1, i, float(x), float(y), float(x + 20), float(y + 20), 1 + i % 3, 0.5) for i, (x, y) in enumerate((37 * k % 1500, 91 * k % 1500) for k in range(400))], "slide_id long, nucleus_id long, x0 double, y0 double, x1 double, y1 double, label int, score double")
    slides = spark.createDataFrame([(1, 2048, 2048)], "slide_id long, h int, w int")
    plans = []
    stored = summary.cut
    monkeypatch.setattr(summary, "cut", lambda rows: plans.append(rows._jdf.queryExecution().analyzed().toString()) or stored(rows))
    additive, edges = summary.tme_features(dets, slides)
    assert sum("n_core" in p for p in plans) == 1
    assert edges.count() > 0 and {r["name"] for r in additive.collect()} >= {"0.radius", "0.count", "0_1.dot", "roi_area"}


def test_blocks_of_a_mask_go_to_python_many_at_a_time(spark):
    rng = np.random.default_rng(2)
    cells = spark.createDataFrame([(s, int(r), int(c)) for s in (1, 2) for r, c in np.argwhere(rng.random((40, 40)) < 0.7)], "slide_id long, gr int, gc int")
    sizes = spark.createDataFrame([(1, 40, 40), (2, 40, 40), (3, 9, 9)], "slide_id long, gh int, gw int")
    assert "FlatMapGroupsInPandas" not in regions._by_block(cells, sizes, 8)._jdf.queryExecution().executedPlan().toString()
    runs = lambda block: sorted(tuple(r) for r in regions.run_cells(regions.filled_runs(cells, sizes, 0.0, block)).collect())
    rings = lambda block: sorted((r["slide_id"], r["ring"], r["area"], [tuple(p) for p in r["vertices"]]) for r in regions.contours(cells, sizes, block=block).collect())
    assert runs(8) == runs(64) and rings(8) == rings(64)


def test_dropped_boxes_leave_in_one_join(spark):
    from nucleispark.operators import nms

    chain = [(1, k, 6.0 * k, 0.0, 6.0 * k + 10, 10.0, 1 - k / 100) for k in range(30)]
    dets = spark.createDataFrame(chain, "slide_id long, nucleus_id long, x0 double, y0 double, x1 double, y1 double, score double")
    kept, rounds = nms.suppress_slides(dets, 0.1, 16, 32)
    assert rounds > 1 and sorted(r["nucleus_id"] for r in kept.collect()) == list(range(0, 30, 2))
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 1


def test_edge_statistics_are_worked_out_once(spark):
    dets = spark.createDataFrame([(1, 1), (2, 2)], "slide_id long, label int")
    edges = spark.createDataFrame([(1, 7, 0, 1, 3.0), (1, 7, 0, 1, 5.0)], "slide_id long, patch_id long, i int, j int, dist double")
    additive = spark.createDataFrame([(1, "0.count", 2.0), (1, "0_0.dot", 4.0)], "slide_id long, name string, value double")
    long = summary.summarize(additive, edges, dets)
    assert "stddev_samp" not in long._jdf.queryExecution().optimizedPlan().toString()
    assert {r["entity"]: r["value"] for r in long.filter("name = '0_1.edges.mean'").collect()} == {"1": 4.0, "2": None}
