"""Column functions: headers, keys, polygons as text, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def magnification(description: Column) -> Column:
    """The first number after `mag =` or `magnitude =`, in any case, also within `AppMag`; null if there is none."""
    return F.nullif(F.regexp_extract(description, r"(?i)(?:mag|magnitude)\s*=\s*([\d.]+)", 1), F.lit("")).try_cast("double")


def microns_per_pixel(description: Column) -> Column:
    return F.nullif(F.regexp_extract(description, r"(?i)mpp\s*=\s*([\d.]+)", 1), F.lit("")).try_cast("double")


def file_stem(path: Column) -> Column:
    """The last part of a path without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"[^/]*$", 0), r"(?<=.)\.[^.]*$", "")


def file_extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(?<=[^/])(\.[^./]*)$", 1))


def polygon_area(vertices: Column) -> Column:
    """Shoelace area of array<struct<x,y>>; the ring is closed if it isn't; 0 below three vertices."""
    after = F.concat(F.slice(vertices, 2, F.greatest(F.size(vertices) - 1, F.lit(0))), F.slice(vertices, 1, 1))
    cross = F.zip_with(vertices, after, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, c: s + c)) / 2


def ascii_text(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def header_text(pairs: Column, separator: str = "|") -> Column:
    """`k=v` of a map, by key, ASCII only."""
    entries = F.array_sort(F.map_entries(pairs))
    return ascii_text(F.array_join(F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit("="), F.coalesce(e["value"].cast("string"), F.lit("")))), separator))


def tile_key(level: Column, col: Column, row: Column) -> Column:
    return F.concat_ws("_", level.cast("string"), col.cast("string"), row.cast("string"))


def parse_tile_key(key: Column) -> Column:
    """struct<level, tile_col, tile_row>; nulls where the key isn't three numbers."""
    part = lambda i: F.get(F.split(key, "_"), F.lit(i)).try_cast("bigint")
    return F.struct(part(0).alias("level"), part(1).alias("tile_col"), part(2).alias("tile_row"))


def vertices_to_text(vertices: Column, axis: str) -> Column:
    """Coordinates of one axis with two decimals, joined by commas; empty for an empty polygon."""
    return F.array_join(F.transform(vertices, lambda p: F.format_string("%.2f", p[axis].cast("double"))), ",")


def text_to_vertices(xs: Column, ys: Column) -> Column:
    numbers = lambda t: F.transform(F.filter(F.split(t, ","), lambda s: s != ""), lambda s: s.cast("double"))
    return F.zip_with(numbers(xs), numbers(ys), lambda x, y: F.struct(x.alias("x"), y.alias("y")))


def half_even(x: Column) -> Column:
    return F.rint(x)


def sigmoid_of_log(p: Column) -> Column:
    """sigmoid(ln p), that is p / (1 + p); null for p <= 0."""
    return F.when(p > 0, p / (1 + p))


def positive_log(x: Column) -> Column:
    return F.when(x > 0, F.log(x))


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b.cast("double"), F.lit(0.0))


def center_padding(size: Column, wanted: Column) -> Column:
    """struct<before, after> that brings `size` to `wanted`; negative widths crop."""
    before = F.floor((wanted - size) / 2)
    return F.struct(before.alias("before"), (wanted - size - before).alias("after"))


def next_multiple(size: Column, of: int = 64) -> Column:
    return (F.ceil(size / of) * of).cast("bigint")
