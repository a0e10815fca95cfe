"""Tile requests as streams: each tile once, with its neighbours, scored in small batches and appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from nucleispark.operators.tiles import OFFSETS

SCHEMA = "event_id long, ts timestamp, slide_id long, tile_col long, tile_row long"


def read_requests(spark: SparkSession, path: str, files_per_batch: int = 32) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def with_neighbors(requests: DataFrame, n_cols: int, n_rows: int) -> DataFrame:
    """A request for each tile of the 3 x 3 neighbourhood within the grid."""
    offsets = F.array(*(F.struct(F.lit(c).alias("dc"), F.lit(r).alias("dr")) for c, r in OFFSETS))
    near = requests.select("event_id", "ts", "slide_id", "tile_col", "tile_row", F.inline(offsets))
    near = near.select("event_id", "ts", "slide_id", (F.col("tile_col") + F.col("dc")).alias("tile_col"), (F.col("tile_row") + F.col("dr")).alias("tile_row"))
    return near.filter(F.col("tile_col").between(0, n_cols - 1) & F.col("tile_row").between(0, n_rows - 1))


def once(requests: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """The first request of each tile while it is within the watermark; later ones of an older time are dropped, and state goes with it."""
    rows = requests.withWatermark("ts", watermark) if requests.isStreaming else requests
    key = ["slide_id", "tile_col", "tile_row"]
    return rows.dropDuplicatesWithinWatermark(key) if requests.isStreaming else rows.dropDuplicates(key)


def progress_stream(requests: DataFrame, tiles_per_slide: int) -> DataFrame:
    """(slide_id, finished, share), approximate, for update mode."""
    key = F.struct("tile_col", "tile_row")
    return requests.groupBy("slide_id").agg(F.approx_count_distinct(key).alias("finished")).withColumn("share", F.least(F.lit(1.0), F.col("finished") / tiles_per_slide))


def service_runs(requests: DataFrame, gap: str = "10 seconds", watermark: str = "10 minutes") -> DataFrame:
    """(slide_id, begin, end, n): runs of requests that end after `gap` without one."""
    rows = requests.withWatermark("ts", watermark) if requests.isStreaming else requests
    found = rows.groupBy("slide_id", F.session_window("ts", gap).alias("run")).agg(F.count("*").alias("n"))
    return found.select("slide_id", F.col("run.start").alias("begin"), F.col("run.end").alias("end"), "n")


def serve(requests: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, every: str = "1 second", once_only: bool = True, all_available: bool = False) -> StreamingQuery:
    """Scores batches of requested tiles and appends what isn't stored yet; a batch that is run again after a failure adds nothing twice."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        key = ["slide_id", "tile_col", "tile_row"]
        open_tiles = rows.dropDuplicates(key)
        try:
            stored = spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        else:
            open_tiles = open_tiles.join(stored.filter(F.col("batch_id") != batch_id).select(*key).distinct(), key, "left_anti")
        score(open_tiles).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    rows = once(requests) if once_only else requests
    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if all_available else writer.trigger(processingTime=every)).start()
