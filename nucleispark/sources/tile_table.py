"""A stored table of tile results, appended batch by batch and read tile by tile.

A batch is written to a folder of its own, by GROUPS groups of slides and sorted by slide and tile, and counts from the moment that its
manifest is there. So a batch that failed half-way isn't seen, one that is tried again replaces what it had left, and one that is
repeated after it went well changes nothing. Fetching a tile reads the folder of its slide's group, and of its files the row groups
with that tile. The number of files goes with the rows, not with the slides.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nucleispark.functions.scalars import tile_key

#: Folders of a batch. A table must be written and read with the same number.
GROUPS = 64
_TILE = ["slide_id", "tile_row", "tile_col"]


def slide_group(slide_id: Column) -> Column:
    return F.pmod(F.xxhash64(slide_id), F.lit(GROUPS)).cast("int")


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """(batch, slide_id, n): the manifests of all batches that were written to the end, or None if there is none."""
    try:
        return spark.read.parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_tiles(dets: DataFrame, path: str, batch: int, level: int = 0) -> bool:
    """Adds tile results (slide_id, tile_col, tile_row, ..) as a batch, with tile_key `level_col_row`; False if that batch is there already."""
    spark = dets.sparkSession
    known = committed(spark, path)
    if known is not None and not known.filter(F.col("batch") == batch).isEmpty():
        return False
    rows = dets.withColumn("tile_key", tile_key(F.lit(level), F.col("tile_col"), F.col("tile_row"))).withColumn("slide_id_group", slide_group(F.col("slide_id")))
    rows = rows.repartitionByRange("slide_id_group", *_TILE).sortWithinPartitions("slide_id_group", *_TILE)
    rows.write.mode("overwrite").partitionBy("slide_id_group").parquet(f"{path}/data/batch={batch}")
    try:
        stored = spark.read.parquet(f"{path}/data/batch={batch}").groupBy("slide_id").agg(F.count("*").alias("n"))
    except AnalysisException:  # a batch without rows
        stored = rows.groupBy("slide_id").agg(F.count("*").alias("n"))
    stored.write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")
    return True


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """All rows of committed batches, with their batch."""
    batches = [r[0] for r in committed(spark, path).select("batch").distinct().collect()]
    return spark.read.option("basePath", f"{path}/data").parquet(*(f"{path}/data/batch={b}" for b in sorted(batches)))


def fetch_tiles(stored: DataFrame, slide_id: object, tile_col: int, tile_row: int, reach: int = 0) -> DataFrame:
    """The rows of one tile, or of all within `reach` tiles of it."""
    near = lambda c, v: F.col(c).between(v - reach, v + reach) if reach else F.col(c) == v
    own = F.lit(slide_id).cast(stored.schema["slide_id"].dataType)
    return stored.filter((F.col("slide_id_group") == slide_group(own)) & (F.col("slide_id") == own) & near("tile_col", tile_col) & near("tile_row", tile_row))
