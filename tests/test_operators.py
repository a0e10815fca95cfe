"""Golden values, borders, missing classes, files and streams."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from nucleispark.functions import scalars
from nucleispark.operators import boxes, features, graph, masks, nms, predict, roi, tiles
from nucleispark.plans.fixtures import table
from nucleispark.sources import io
from nucleispark.streaming import requests as stream

FOLDER = "/root/testdata/sf0.001"
BOX = "slide_id long, nucleus_id long, x0 double, y0 double, x1 double, y1 double, label int, score double"


def box(k, x, y, label=1, score=0.9, r=4.0, slide=1):
    return (slide, k, float(x - r), float(y - r), float(x + r), float(y + r), label, score)


def test_ratios_of_the_golden_row(spark):
    """Known raw products, counts and edge counts, and the ratios that belong to them."""
    dots = {(0, 0): 2.841630220413208, (0, 1): 0.8296251893043518, (0, 2): 0.11552618443965912, (1, 1): 1.715371012687683, (1, 2): 0.43899911642074585, (2, 2): 2.257014513015747}
    got = {r["name"]: r["value"] for r in features.density_ratios(spark.createDataFrame([(1, i, j, d) for (i, j), d in dots.items()], "slide_id int, i int, j int, dot double")).collect()}
    wanted = {"0.norm": 1.6857135641659908, "2.norm.logit": 0.40702146401940204, "0_1.proj": 0.48364183792780535, "1_0.proj.logit": -1.2311591680936282, "2_1.proj.prob": 0.203771445996804, "0_2.cos": 0.04561728907184411}
    assert {k: pytest.approx(v, abs=1e-6) for k, v in wanted.items()} == {k: got[k] for k in wanted}
    edges = {(0, 0): 32698, (0, 1): 8802, (0, 2): 500, (1, 1): 2932, (1, 2): 429, (2, 2): 52}
    got = {r["name"]: r["value"] for r in features.edge_ratios(spark.createDataFrame([(1, i, j, n) for (i, j), n in edges.items()], "slide_id int, i int, j int, n long")).collect()}
    wanted = {"0_1.edges.marginal.prob": 0.19382115253341553, "0_1.edges.conditional.prob": 0.7236701471676396, "2_1.edges.conditional.prob": 0.03527090355997698, "0_1.edges.dice": 0.32501892435795654}
    assert {k: pytest.approx(v, abs=1e-9) for k, v in wanted.items()} == {k: got[k] for k in wanted}
    got = {r["name"]: r["value"] for r in features.count_ratios(spark.createDataFrame([(1, 0, 7800), (1, 1, 1787), (1, 2, 114)], "slide_id int, cls int, n long")).collect()}
    assert got["0.count.prob"] == pytest.approx(0.8040408205339655)


def test_golden_plan(spark):
    slide = spark.createDataFrame([(1, 13347, 31872, 0.2457)], "slide_id int, h int, w int, mpp double")
    row = tiles.inference_window(slide).first()
    assert (row["window"], row["pad"], row["run_mpp"]) == (512, 64, pytest.approx(0.2457))
    grid = tiles.tile_grid(slide, 512)
    assert grid.count() == 27 * 63
    assert grid.agg(F.sum(F.col("w") * F.col("h"))).first()[0] == 13347 * 31872


def test_trim_keeps_each_nucleus_once_but_none_on_borders(spark):
    slide = spark.createDataFrame([(1, 1024, 1024)], "slide_id long, h int, w int")
    plan = tiles.pad_tiles(tiles.tile_grid(slide, 512), 64)
    inside, border = [box(1, 100, 100), box(2, 510, 300), box(3, 514, 514)], [box(4, 512, 100), box(5, 300, 512)]
    dets = spark.createDataFrame(inside + border, BOX)
    seen = dets.crossJoin(plan.select("tile_col", "tile_row", "src_x", "src_y", "src_w", "src_h"))
    xc, yc = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    seen = seen.filter((xc >= F.col("src_x")) & (xc < F.col("src_x") + F.col("src_w")) & (yc >= F.col("src_y")) & (yc < F.col("src_y") + F.col("src_h")))
    left, up = F.col("tile_col") * 512 - 64, F.col("tile_row") * 512 - 64
    local = seen.select("slide_id", "tile_col", "tile_row", "nucleus_id", (F.col("x0") - left).alias("x0"), (F.col("x1") - left).alias("x1"), (F.col("y0") - up).alias("y0"), (F.col("y1") - up).alias("y1"))
    plan = plan.withColumns({"pad_l": F.lit(64), "pad_u": F.lit(64)})
    ids = sorted(r["nucleus_id"] for r in boxes.tile_to_slide(local, plan).collect())
    assert ids == [1, 2, 3]
    assert sorted(r["nucleus_id"] for r in boxes.tile_to_slide(local, plan, closed_left=True).collect()) == [1, 2, 3, 4, 5]


def test_absent_classes_and_single_nuclei(spark):
    dets = spark.createDataFrame([box(1, 10, 10), box(2, 30, 30, label=2), box(3, 50, 50, label=2, r=6)], BOX)
    got = {r["cls"]: r["radius"] for r in features.class_radius(dets, 3).collect()}
    assert got == {0: 4.0, 1: 4.0, 2: None}  # the lower median
    stats = {r["label"]: r for r in features.morphology_stats(boxes.box_columns(dets)).collect()}
    assert stats[1]["box_area_std"] is None and stats[2]["total"] == 2
    empty = dets.filter("label = 9")
    assert features.class_radius(empty, 3).count() == 0 and nms.nms_by_slide(empty, 0.5).count() == 0
    pairs = graph.edge_stats(spark.createDataFrame([], "slide_id long, i int, j int, dist double"), dets, 2).collect()
    assert [(r["i"], r["j"], r["mean"], r["n"]) for r in sorted(pairs)] == [(0, 0, None, 0), (0, 1, None, 0), (1, 1, None, 0)]


def test_nms_keeps_no_overlap_and_drops_for_a_reason(spark):
    rows = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for r in table(spark, FOLDER, "detections").limit(400).collect()]
    dets = spark.createDataFrame(rows, BOX).withColumns({"slide_id": F.lit(1).cast("long"), "nucleus_id": F.monotonically_increasing_id()}).persist()
    kept = {r["nucleus_id"] for r in nms.nms_by_slide(dets, 0.1, 64).collect()}
    pairs = [(r["better"], r["worse"]) for r in nms.overlapping_pairs(dets, 0.1, 64).collect()]
    assert not [p for p in pairs if p[0] in kept and p[1] in kept]
    lost = {r["nucleus_id"] for r in dets.collect()} - kept
    assert lost == {w for b, w in pairs if b in kept}


def test_run_lengths_of_full_and_empty_masks(spark):
    grid = spark.createDataFrame([(k, y, x, v) for k, v in ((1, True), (2, False)) for y in range(3) for x in range(4)], "k int, y int, x int, mask boolean")
    got = {r["k"]: list(r["counts"]) for r in masks.rle_encode(grid, "k", 3).collect()}
    assert got == {1: [0, 12], 2: [12]}
    assert masks.rle_decode(masks.rle_encode(grid, "k", 3), "k", 3).count() == 12


def test_sampled_points_lie_in_their_polygon(spark):
    a = [(22, 2), (0, 1), (2, 16), (11, 18), (12, 15), (8, 12), (10, 4), (20, 6), (22, 2)]
    b = [(30 - x, 30 - y) for x, y in a]
    polys = spark.createDataFrame([(1, k, [{"x": float(x), "y": float(y)} for x, y in p]) for k, p in ((1, a), (2, b))], "slide_id int, poly_id int, vertices array<struct<x:double,y:double>>")
    points = roi.sample_in_polygons(polys, 200).persist()
    assert points.count() == 200 and {r["poly_id"] for r in points.select("poly_id").distinct().collect()} == {1, 2}
    held = roi.points_in_polygons(points.drop("poly_id"), polys, 8)
    assert held.count() == 200
    assert sorted(map(tuple, points.collect())) == sorted(map(tuple, roi.sample_in_polygons(polys, 200).collect()))


def test_header_numbers(spark):
    rows = spark.createDataFrame([("Aperio |AppMag = 40|MPP=0.2457",), ("magnitude= 20",), ("none",), (None,)], "d string")
    got = [tuple(r) for r in rows.select(scalars.magnification(F.col("d")), scalars.microns_per_pixel(F.col("d"))).collect()]
    assert got == [(40.0, 0.2457), (20.0, None), (None, None), (None, None)]


def test_files_round_trip(spark, tmp_path):
    for name in ("a/x.svs", "a/x.xml", "b/y.svs", "b/.hidden.svs"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text("<Annotations><Annotation><Regions><Region Text='ROI'><Vertices><Vertex X='1.0' Y='2.0'/></Vertices></Region></Regions></Annotation></Annotations>")
    files = io.list_inputs(spark, str(tmp_path / "in")).persist()
    slides, ann = files.filter("extension = '.svs'"), files.filter("extension = '.xml'")
    assert sorted(r["relative"] for r in slides.collect()) == ["a/x.svs", "b/y.svs"]
    paired = {r["stem"]: r["ann_file"] for r in io.pair_annotations(slides, ann).collect()}
    assert paired["x"].endswith("a/x.xml") and paired["y"] is None
    region = io.read_annotations(spark, str(tmp_path / "in/a/x.xml")).first()
    assert region["label"] == "ROI" and [tuple(v) for v in region["vertices"]] == [(1.0, 2.0)]

    dets = spark.createDataFrame([(*box(1, 10.25, 20.75), 1, 2, [{"x": 0.0, "y": 1.5}])], BOX + ", tile_col int, tile_row int, mask_poly array<struct<x:double,y:double>>")
    out = io.export_detections(dets, io.class_table(spark), save_masks=True)
    out.drop("slide_id", "nucleus_id").write.option("header", True).csv(str(tmp_path / "csv"))
    back = io.read_detections(spark, str(tmp_path / "csv")).first()
    assert (back["x0"], back["y1"], back["label"], back["poly_x"], back["poly_y"]) == (6, 25, "tumor", "6.00", "18.50")

    io.append_detections(dets, str(tmp_path / "store"))
    io.append_detections(dets, str(tmp_path / "store"))
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert boxes.fetch_tile(stored, 1, "0_1_2").count() == 2
    assert io.pending(spark.createDataFrame([(1,), (2,)], "slide_id long"), stored).collect()[0][0] == 2
    (tmp_path / "map.csv").write_text("slide_id,patient_id\n1,p\n")
    assert io.read_patient_map(spark, str(tmp_path / "map.csv")).first()["patient_id"] == "p"
    plan = tiles.number_tiles(tiles.tile_grid(spark.createDataFrame([(1, 600, 600)], "slide_id int, h int, w int"), 512))
    io.write_plan(plan, str(tmp_path / "plan"))
    assert io.read_plan(spark, str(tmp_path / "plan")).count() == 4
    long = spark.createDataFrame([(1, "0.radius", 2.0)], "slide_id int, name string, value double")
    io.write_feature_summary(long, "slide_id", 3, str(tmp_path / "summary"))
    wide = spark.read.option("header", True).csv(str(tmp_path / "summary"))
    assert len(wide.columns) == 1 + len(features.feature_names(3))
    assert io.attach_masks(dets.select("slide_id", "nucleus_id"), dets.select("slide_id", "nucleus_id", "mask_poly")).first()["mask_poly"]


def test_detector_makes_its_model_once_a_worker(spark):
    slide = spark.createDataFrame([(1, 1024, 1024)], "slide_id long, h int, w int")
    plan = tiles.pad_tiles(tiles.tile_grid(slide, 512), 64).withColumns({"pad_l": F.lit(64), "pad_u": F.lit(64)})
    from nucleispark.plans.queries_tiles import planted_detector

    found = predict.detect_slides(plan, planted_detector, 0.2, 0.5, 1000)
    assert found.count() == 4 * 5


def test_requests_stream_once_and_resume(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:0{i % 5}:00", 1, i % 3, 0) for i in range(12)]
    batch = spark.createDataFrame(rows, "event_id long, ts string, slide_id long, tile_col long, tile_row long").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartition(3).write.parquet(str(tmp_path / "in"))

    def score(open_tiles):
        return open_tiles.select("slide_id", "tile_col", "tile_row", F.lit(1.0).alias("score"))

    def run():
        source = stream.read_requests(spark, str(tmp_path / "in"), 1)
        stream.serve(source, score, str(tmp_path / "out"), str(tmp_path / "state"), all_available=True).awaitTermination()

    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["tile_col"] for r in out.collect()) == [0, 1, 2]
    late = spark.createDataFrame([(99, "2023-01-01 00:00:00", 1, 7, 0), (100, "2024-01-01 00:04:30", 1, 5, 0)], "event_id long, ts string, slide_id long, tile_col long, tile_row long")
    late.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["tile_col"] for r in out.collect()) == [0, 1, 2, 5]  # the late one is dropped
    runs = stream.service_runs(batch).collect()
    assert sum(r["n"] for r in runs) == 12
    near = stream.with_neighbors(batch.filter("event_id = 0"), 3, 3)
    assert near.count() == 4


def test_outlines_of_overlapping_labels_against_brute_force(spark, monkeypatch):
    from nucleispark.plans import queries_masks

    rng = np.random.default_rng(12)
    corners = rng.uniform(-5, 60, (40, 2))
    rows = [(0, i, float(x), float(y), float(x + w), float(y + h), int(label), float(score)) for i, ((x, y), (w, h), label, score) in enumerate(zip(corners, rng.uniform(6, 25, (40, 2)), rng.choice([-100, 0, 1, 2, 3, 4], 40), rng.uniform(0, 1, 40), strict=True))]
    dets = spark.createDataFrame(rows, "slide_id long, nucleus_id long, x0 double, y0 double, x1 double, y1 double, label int, score double")
    monkeypatch.setattr(queries_masks, "tables", lambda *_: (dets, spark.createDataFrame([(0, 64, 64)], "slide_id long, h int, w int")))
    want: dict[tuple[int, int], int] = {}
    for _, _, *box, label, _ in (r for r in rows if r[6] > 0):
        x0, y0, x1, y1 = (min(max(round(v), 0), 64) for v in box)
        for y in range(y0, y1):
            for x in range(x0, x1):
                if y < y0 + 3 or y >= y1 - 3 or x < x0 + 3 or x >= x1 - 3:
                    want[y, x] = max(label, want.get((y, x), label))
    got = {(r["y"], r["x"]): r["label"] for r in queries_masks.G12_outline_pixels_all(spark, "").collect()}
    assert got == want and len(set(want.values())) > 3


def test_smoothing_in_blocks_is_smoothing_of_whole_slides(spark):
    import numpy as np

    from nucleispark.kernels import conv
    from nucleispark.operators import density
    from nucleispark.session import on_workers

    on_workers(spark)
    rng = np.random.default_rng(8)
    sizes, radii = {1: (40, 70), 2: (33, 20)}, {(1, 0): 16.0, (1, 1): None, (2, 0): 1.0, (2, 1): 9.5}
    rows = sorted({(s, c, int(rng.integers(h)), int(rng.integers(w))) for s, (h, w) in sizes.items() for c in (0, 1) for _ in range(60)})
    pooled = spark.createDataFrame([(*r, float(i % 7 + 1)) for i, r in enumerate(rows)], "slide_id long, cls int, gr int, gc int, d double")
    radius = spark.createDataFrame([(s, c, r) for (s, c), r in radii.items()], "slide_id long, cls int, radius double")
    table = spark.createDataFrame([(s, h, w) for s, (h, w) in sizes.items()], "slide_id long, gh int, gw int")
    got = {(r["slide_id"], r["cls"], r["gr"], r["gc"]): r["d"] for r in density.smooth_density(pooled, radius, table, 1 / 32, block=16).collect()}
    want = {}
    for (s, c), r in radii.items():
        image = np.zeros(sizes[s])
        for i, (s2, c2, gr, gc) in enumerate(rows):
            if (s2, c2) == (s, c):
                image[gr, gc] = i % 7 + 1
        kernel = conv.density_kernel(r, 1 / 32)
        out = image if kernel is None else conv.correlate(image, kernel)
        want |= {(s, c, int(i), int(j)): out[i, j] for i, j in zip(*np.nonzero(out), strict=True)}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_features_of_random_patches(spark):
    """Counts and edges of the record against its own patches, taken apart by hand."""
    from nucleispark.operators import density, features, graph, roi, summary
    from nucleispark.plans.fixtures import table
    from nucleispark.session import on_workers

    on_workers(spark)
    folder = "/root/testdata/sf0.001"
    dets, slides = table(spark, folder, "detections"), table(spark, folder, "slides")
    additive, edges = summary.tme_features(dets, slides)
    values = {(r["slide_id"], r["name"]): r["value"] for r in additive.collect()}
    cells, sizes = density.nuclei_map(dets.filter("label between 1 and 3")), density.pooled_sizes(slides, 32)
    smooth = density.smooth_density(density.pool_density(cells, slides, 32), features.class_radius(dets.filter("label between 1 and 3"), 3), sizes, 1 / 32)
    region = roi.fill_and_label(roi.roi_cells(smooth, (0,)), sizes)
    points = roi.sample_in_cells(region, 200, 32)
    inside = {(r["slide_id"], r["gr"], r["gc"]) for r in region.collect()}
    assert all((p["slide_id"], int(p["y"] // 32), int(p["x"] // 32)) in inside for p in points.collect())
    patches = roi.random_patches(points, slides, cells, 20, 512).collect()
    side = {r["slide_id"]: (r["h"], r["w"]) for r in slides.collect()}
    where = {}
    for c in cells.collect():
        where.setdefault(c["slide_id"], []).append((c["row"], c["col"], c["cls"]))
    counts = {}
    for s in side:
        mine = sorted((p for p in patches if p["slide_id"] == s), key=lambda p: p["rank"])
        boxes = [(p["x"], p["y"]) for p in mine]
        for k, p in enumerate(mine):
            own = [c for r, q, c in where[s] if p["y"] <= r < p["y"] + 512 and p["x"] <= q < p["x"] + 512]
            assert (len(own), sum(c == 0 for c in own)) == (p["n_points"], p["n_core"])
            assert 0 <= p["x"] <= max(0, side[s][1] - 512) and 0 <= p["y"] <= max(0, side[s][0] - 512)
            for x, y in boxes[:k]:
                both = max(0, 512 - abs(x - p["x"])) * max(0, 512 - abs(y - p["y"]))
                assert both / (2 * 512 * 512 - both) <= 0.3
        for p in [p for p in mine if p["n_points"] >= 10 and p["n_core"] >= 10][:10]:
            for r, q, c in where[s]:
                if p["y"] <= r < p["y"] + 512 and p["x"] <= q < p["x"] + 512:
                    counts[s, c] = counts.get((s, c), 0) + 1
    assert counts and all(values[s, f"{c}.count"] == counts.get((s, c), 0) for s in side for c in range(3) if (s, f"{c}.count") in values)
    assert edges.count() > 0 and graph.edge_stats(edges, dets.filter("label between 1 and 3"), 3).agg({"n": "sum"}).first()[0] == edges.count()


def test_label_images_of_boxes_masks_and_polygons(spark):
    import numpy as np

    from nucleispark.operators import masks, pixels
    from nucleispark.session import on_workers

    on_workers(spark)
    rng = np.random.default_rng(4)
    boxes = [(1, int(l), int(x), int(y), int(x + w), int(y + h)) for l, x, y, w, h in zip(rng.integers(1, 5, 30), *rng.integers(0, 30, (2, 30)), *rng.integers(0, 9, (2, 30)), strict=True)]
    want = {}
    for _, label, x0, y0, x1, y1 in boxes:
        want |= {(y, x): max(label, want.get((y, x), 0)) for y in range(y0, y1) for x in range(x0, x1)}
    got = pixels.filled_pixels(spark.createDataFrame(boxes, "slide_id long, label int, x0 int, y0 int, x1 int, y1 int")).collect()
    assert {(r["y"], r["x"]): r["label"] for r in got} == want and len(got) == len(want)
    dets = spark.createDataFrame([(1, 2, 3.0, 4.0, 9.0, 7.0, [1.0] * 784), (1, 5, 5.0, 5.0, 20.0, 20.0, [0.0] * 784), (1, 3, 8.0, 4.0, 8.0, 4.0, [1.0] * 784)], "slide_id long, label int, x0 double, y0 double, x1 double, y1 double, soft array<double>")
    image = {(r["y"], r["x"]): r["label"] for r in pixels.label_image(masks.mask_pixels(dets)).collect()}
    assert image == {(y, x): 3 if (y, x) == (4, 8) else 2 for y in range(4, 8) for x in range(3, 10)}
    square = [{"x": float(x), "y": float(y)} for x, y in ((2, 3), (6, 3), (6, 8), (2, 8))]
    polygons = spark.createDataFrame([(1, 7, square), (1, 8, [])], "slide_id long, label int, vertices array<struct<x:double,y:double>>")
    assert {(r["y"], r["x"]) for r in masks.polygon_pixels(polygons).collect()} == {(y, x) for y in range(3, 9) for x in range(2, 7)}
    shape = masks.region_props(dets, names=(), more={"filled": lambda m: float(m.sum())}).collect()
    assert [r["filled"] for r in shape] == [28.0, None, 1.0]


def test_polygons_as_annotation_rows_regions_and_coverage(spark):
    from nucleispark.operators import annotations, masks, roi, tiles

    rings = {1: [(0, 0), (64, 0), (64, 40), (0, 40)], 2: [(100, 100), (140, 100), (100, 140)]}
    rows = [(1, k, 9, k + 1, [{"x": float(x), "y": float(y)} for x, y in v]) for k, v in rings.items()]
    polygons = spark.createDataFrame(rows, "slide_id long, id long, image_id long, label int, vertices array<struct<x:double,y:double>>").withColumn("poly_id", F.col("id"))
    back = masks.from_coco_polygons(masks.to_coco_polygons(polygons)).orderBy("id").collect()
    assert [(r["id"], r["image_id"], r["label"], [(p["x"], p["y"]) for p in r["vertices"]]) for r in back] == [(k, 9, k + 1, [tuple(map(float, q)) for q in v]) for k, v in rings.items()]
    cells = {(r["gr"], r["gc"]) for r in roi.cells_of_polygons(polygons, 8).collect()}
    assert {(r, c) for r, c in cells if r < 12} == {(r, c) for r in range(5) for c in range(8)} and all(8 * (r + c + 1) <= 240 for r, c in cells)
    grid = spark.createDataFrame([(1, c, r, 64 * c, 64 * r, 64, 64) for c in range(3) for r in range(3)], "slide_id long, tile_col int, tile_row int, x int, y int, w int, h int")
    got = {(r["tile_col"], r["tile_row"]): (r["coverage"], r["poly_id"]) for r in tiles.polygon_coverage(grid, polygons, 64).collect()}
    assert got[0, 0] == (40 / 64, 1) and got[1, 1][1] == 2 and abs(got[1, 1][0] - (28 * 28 - 16 * 16 / 2) / 4096) < 0.03 and got[2, 0] == (0.0, 0)
    assert annotations.roi_regions(polygons, polygons) is polygons and annotations.roi_regions(polygons, lambda a: a.filter("id = 2")).count() == 1


def test_tissue_from_pixels(spark):
    """A noisy square with a flat hole on a flat ground, and a noisy speck apart."""
    import numpy as np

    from nucleispark.operators import pixels
    from nucleispark.session import on_workers

    on_workers(spark)
    rng = np.random.default_rng(5)
    noisy = {(r, c) for r in range(1, 6) for c in range(1, 6)} - {(3, 3)} | {(8, 8)}
    rows = [(1, y, x, *(int(v) for v in (rng.integers(0, 256, 3) if (y // 8, x // 8) in noisy else (240, 240, 240)))) for y in range(80) for x in range(80)]
    image = spark.createDataFrame(rows, "slide_id long, y int, x int, r int, g int, b int")
    sizes = spark.createDataFrame([(1, 10, 10)], "slide_id long, gh int, gw int")
    found = {(r["gr"], r["gc"]) for r in pixels.tissue_from_pixels(image, "slide_id", sizes, block=8, least_share=0.1).collect()}
    assert found == noisy - {(8, 8)} | {(3, 3)}


def test_progress_of_a_stream(spark, tmp_path):
    from nucleispark.streaming import requests

    rows = [(s, c, r) for s in (1, 2) for c in range(4) for r in range(2 * s)] * 2
    spark.createDataFrame(rows, "slide_id long, tile_col int, tile_row int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("slide_id long, tile_col int, tile_row int").parquet(f"{tmp_path}/in")
    run = requests.progress_stream(stream, 16).writeStream.format("memory").queryName("progress").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    run.awaitTermination(60)
    got = {r["slide_id"]: (r["finished"], r["share"]) for r in spark.table("progress").collect()}
    assert abs(got[1][0] - 8) <= 1 and got[2][0] <= 17 and got[2][1] <= 1.0 and got[1][1] == got[1][0] / 16
