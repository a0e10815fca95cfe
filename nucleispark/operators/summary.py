"""The whole way from detections to the feature summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.operators import boxes, density, features, graph, regions, roi
from nucleispark.session import checkpointed as cut


def tme_features(dets: DataFrame, slides: DataFrame, n_classes: int = 3, divisor: int = 32, patch: int = 512, n_patches: int = 10, max_dist: float = 100.0, core: tuple[int, ...] = (0,)) -> tuple[DataFrame, DataFrame]:
    """(additive features as (slide_id, name, value), edges (slide_id, patch_id, i, j, dist)): radius, patch counts, density products and
    region area. Patches of `patch` pixels lie around random points of the region: of 20 * n_patches the best 2 * n_patches that overlap
    little, and of those the first n_patches with enough points."""
    dets = boxes.filter_labels(dets, n_classes)
    radius = cut(features.class_radius(dets, n_classes))
    cells = cut(density.nuclei_map(dets))
    sizes = density.pooled_sizes(slides, divisor)
    smooth = cut(density.smooth_wide(density.pool_density(cells, slides, divisor), radius, sizes, 1 / divisor, n_classes))
    dots = density.wide_products(smooth, n_classes)
    inside = smooth.filter(F.greatest(F.lit(0.0), *(F.col(f"d{c}") for c in core)) > 0).select("slide_id", "gr", "gc")
    runs = cut(regions.filled_runs(inside, sizes))
    area = roi.roi_area(regions.run_cells(runs), sizes, divisor)
    tries = roi.random_patches(roi.sample_in_runs(runs, 20 * n_patches, divisor), slides, cells, 2 * n_patches, patch, core=core)
    chosen = graph.choose_patches(tries.drop("rank", "name"), n_patches)
    points = cut(graph.points_in_patches(cells, chosen, patch))
    edges = cut(graph.delaunay_edges(points, max_dist))
    parts = [
        features.long_features(radius, "slide_id", F.col("cls").cast("string"), {"radius": F.col("radius")}),
        features.long_features(graph.patch_counts(points, cells, n_classes), "slide_id", F.col("cls").cast("string"), {"count": F.col("n")}),
        features.long_features(dots, "slide_id", F.concat_ws("_", "i", "j"), {"dot": F.col("dot")}),
        area.select("slide_id", F.lit("roi_area").alias("name"), F.col("roi_area").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut(out), edges


def summarize(additive: DataFrame, edges: DataFrame, dets: DataFrame, n_classes: int = 3, patients: DataFrame | None = None, morphology: tuple[str, ...] = ()) -> DataFrame:
    """(entity, name, value): additive features and edges, merged by patient where a map (slide_id, patient_id) is given, with all
    ratios. entity is the slide or patient as text. A merged radius is the sum, as for all additive features. morphology: columns of
    dets, of whose nuclei `label.total` and `label.column.mean` and `.std` are added."""
    if patients is not None:
        merged = features.merge_by_patient(additive, patients)
        who = patients.select("slide_id", F.col("patient_id").cast("string").alias("_p"))
        name = F.coalesce("_p", F.concat(F.lit("slide:"), F.col("slide_id").cast("string")))
        edges, dets = (t.join(who, "slide_id", "left").withColumn("slide_id", name).drop("_p") for t in (edges, dets))
        additive = merged.withColumnRenamed("patient_id", "slide_id")
    else:
        edges, dets, additive = (t.withColumn("slide_id", F.col("slide_id").cast("string")) for t in (edges, dets, additive))
    pair = F.split(F.substring_index("name", ".", 1), "_")
    dots = additive.filter(F.col("name").endswith(".dot")).select("slide_id", pair[0].try_cast("int").alias("i"), pair[1].try_cast("int").alias("j"), F.col("value").alias("dot"))
    counts = additive.filter(F.col("name").rlike(r"^\d+\.count$")).select("slide_id", F.substring_index("name", ".", 1).try_cast("int").alias("cls"), F.col("value").alias("n"))
    stats = cut(graph.edge_stats(edges, dets, n_classes))  # read many times below
    values = {"edges.mean": F.col("mean"), "edges.std": F.col("std"), "edges.count": F.col("n")}
    parts = [additive.select("slide_id", "name", "value"), features.long_features(stats, "slide_id", F.concat_ws("_", "i", "j"), values), features.density_ratios(dots), features.count_ratios(counts), features.edge_ratios(stats)]
    if morphology:
        shapes = features.morphology_stats(dets, morphology)
        own = {"total": F.col("total")} | {f"{c}.{s}": F.col(f"{c}_{s}") for c in morphology for s in ("mean", "std")}
        parts.append(features.long_features(shapes, "slide_id", F.col("label").cast("string"), own))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("slide_id", "entity")
