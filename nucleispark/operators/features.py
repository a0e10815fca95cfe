"""Per-class statistics, feature tables in long and wide form, and merging by patient."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement, permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nucleispark.functions.scalars import positive_log, ratio, sigmoid_of_log
from nucleispark.operators.boxes import box_columns

MORPHOLOGY = (
    "box_area", "area", "convex_area", "eccentricity", "extent", "filled_area", "major_axis_length", "minor_axis_length", "orientation", "perimeter", "solidity", "pa_ratio",
)


def class_radius(dets: DataFrame, n_classes: int) -> DataFrame:
    """(slide_id, cls, radius): half the lower median of box sides; null for classes a slide lacks. cls = label - 1."""
    sides = box_columns(dets).filter(F.col("label").between(1, n_classes)).select("slide_id", (F.col("label") - 1).alias("cls"), "box_side")
    found = sides.groupBy("slide_id", "cls").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY box_side) / 2").alias("radius"))
    return each_class(dets, n_classes).join(found, ["slide_id", "cls"], "left")


def each_class(dets: DataFrame, n_classes: int) -> DataFrame:
    """(slide_id, cls) for each slide and class index."""
    return dets.select("slide_id").distinct().withColumn("cls", F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))))


def label_totals(dets: DataFrame) -> DataFrame:
    return dets.groupBy("slide_id", "label").agg(F.count("*").alias("total"))


def morphology_stats(nuclei: DataFrame, columns: Sequence[str] = ("box_area",)) -> DataFrame:
    """(slide_id, label, total, `c`_mean, `c`_std); sample deviations, null for a single nucleus."""
    stats = [s for c in columns for s in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))]
    return nuclei.groupBy("slide_id", "label").agg(F.count("*").alias("total"), *stats)


def nuclei_table(nuclei: DataFrame) -> DataFrame:
    """Boxes, centres, label, score and whatever morphology columns there are."""
    return box_columns(nuclei, rounded=True).select("slide_id", "nucleus_id", "x0", "y0", "x1", "y1", "x_c", "y_c", F.col("label").alias("labels"), F.col("score").alias("scores"), *(c for c in MORPHOLOGY if c in [*nuclei.columns, "box_area"]))


def long_features(table: DataFrame, entity: str, name: Column, values: dict[str, Column]) -> DataFrame:
    """(entity, name, value): one row for each row and value, called `name`.`key`."""
    pairs = F.array(*(F.struct(F.concat_ws(".", name, F.lit(k)).alias("name"), v.cast("double").alias("value")) for k, v in values.items()))
    return table.select(entity, F.inline(pairs))


def pivot_features(features: DataFrame, entity: str, names: Sequence[str]) -> DataFrame:
    """One row for each entity, a column for each of the given names, so that columns don't hang on the data."""
    return features.groupBy(entity).pivot("name", list(names)).agg(F.first("value", ignorenulls=True))


def rename_features(features: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Class indices in the first dotted part of a name (`0_1.dot`) replaced by texts; unknown ones stay."""
    known = F.create_map(*(F.lit(x) for kv in texts.items() for x in kv))
    first, rest = F.substring_index("name", ".", 1), F.expr("substring(name, length(substring_index(name, '.', 1)) + 1)")
    named = F.array_join(F.transform(F.split(first, "_"), lambda p: F.coalesce(F.element_at(known, p), p)), "_")
    return features.withColumn("name", F.concat(named, rest))


def feature_names(n_classes: int) -> list[str]:
    """Names of the wide summary, in order, without morphology."""
    c = range(n_classes)
    pairs, mixed, ordered = list(combinations_with_replacement(c, 2)), list(combinations(c, 2)), list(permutations(c, 2))
    return [
        *(f"{i}_{j}.edges.{s}" for s in ("mean", "std", "count") for i, j in pairs), "roi_area", *(f"{i}.radius" for i in c), *(f"{i}.count" for i in c), *(f"{i}_{j}.dot" for i, j in pairs),
        *(f"{i}.{s}" for i in c for s in ("norm", "norm.logit")), *(f"{i}_{j}.{s}" for i, j in ordered for s in ("proj", "proj.logit", "proj.prob")), *(f"{i}_{j}.cos" for i, j in mixed),
        *(f"{i}.count.prob" for i in c), *(f"{i}_{j}.edges.marginal.prob" for i, j in pairs), *(f"{i}_{j}.edges.conditional.prob" for i, j in ordered), *(f"{i}_{j}.edges.dice" for i, j in mixed),
    ]


def merge_by_patient(features: DataFrame, patients: DataFrame, entity: str = "slide_id") -> DataFrame:
    """(patient_id, name, value): sums of additive features over a patient's slides; entities without a patient stay alone."""
    own = features.join(patients.select(entity, F.col("patient_id").cast("string").alias("patient_id")), entity, "left")
    who = F.coalesce("patient_id", F.concat(F.lit("slide:"), F.col(entity).cast("string")))
    return own.groupBy(who.alias("patient_id"), "name").agg(F.sum("value").alias("value"))


def totals_by_level(features: DataFrame, patients: DataFrame, entity: str = "slide_id") -> DataFrame:
    """Sums of additive features by slide, by patient and over all, as a rollup."""
    own = features.join(patients.select(entity, "patient_id"), entity)
    return own.rollup("name", "patient_id", entity).agg(F.sum("value").alias("value")).filter("name is not null")


def density_ratios(dots: DataFrame, entity: str = "slide_id") -> DataFrame:
    """(entity, name, value) from (entity, i, j, dot), i <= j: norms, ordered projections dot_ij / dot_jj, cosines.

    Logarithms and quotients of zeros are null.
    """
    own = dots.filter("i = j").select(entity, F.col("i").alias("k"), F.col("dot").alias("self"))
    norms = own.withColumn("norm", F.sqrt("self"))
    first = long_features(norms, entity, F.col("k").cast("string"), {"norm": F.col("norm"), "norm.logit": positive_log(F.col("norm"))})
    mixed = dots.filter("i < j")
    ordered = mixed.select(entity, F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))).alias("p"), "dot").select(entity, "p.*", "dot")
    p = ratio(F.col("dot"), F.col("self"))
    proj = ordered.join(own.withColumnRenamed("k", "j"), [entity, "j"])
    second = long_features(proj, entity, F.concat_ws("_", "i", "j"), {"proj": p, "proj.logit": positive_log(p), "proj.prob": sigmoid_of_log(p)})
    both = mixed.join(norms.select(entity, F.col("k").alias("i"), F.col("norm").alias("ni")), [entity, "i"]).join(norms.select(entity, F.col("k").alias("j"), F.col("norm").alias("nj")), [entity, "j"])
    third = long_features(both, entity, F.concat_ws("_", "i", "j"), {"cos": ratio(ratio(F.col("dot"), F.col("ni")), F.col("nj"))})
    return first.unionByName(second).unionByName(third)


def count_ratios(counts: DataFrame, entity: str = "slide_id") -> DataFrame:
    """(entity, name, value) from (entity, cls, n): each class's share."""
    total = counts.groupBy(entity).agg(F.sum("n").alias("total"))
    return long_features(counts.join(total, entity), entity, F.col("cls").cast("string"), {"count.prob": ratio(F.col("n"), F.col("total"))})


def edge_ratios(edges: DataFrame, entity: str = "slide_id") -> DataFrame:
    """(entity, name, value) from (entity, i, j, n), i <= j, all pairs there: marginal, conditional e_ij / sum_k e_kj, and dice shares.

    A class's own total counts its self pair once.
    """
    total = edges.groupBy(entity).agg(F.sum("n").alias("total"))
    ends = F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))
    own = edges.select(entity, F.explode(ends).alias("k"), "n").groupBy(entity, "k").agg(F.sum("n").alias("e"))
    name = F.concat_ws("_", "i", "j")
    first = long_features(edges.join(total, entity), entity, name, {"edges.marginal.prob": ratio(F.col("n"), F.col("total"))})
    mixed = edges.filter("i < j").join(own.select(entity, F.col("k").alias("i"), F.col("e").alias("ei")), [entity, "i"]).join(own.select(entity, F.col("k").alias("j"), F.col("e").alias("ej")), [entity, "j"])
    second = long_features(mixed, entity, name, {"edges.conditional.prob": ratio(F.col("n"), F.col("ej")), "edges.dice": ratio(2 * F.col("n"), F.col("ei") + F.col("ej"))})
    third = long_features(mixed, entity, F.concat_ws("_", "j", "i"), {"edges.conditional.prob": ratio(F.col("n"), F.col("ei"))})
    return first.unionByName(second).unionByName(third)
