"""A stored tile table: batches that fail, come again or are empty, and what a fetch reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from nucleispark.sources import tile_table


def rows_of(spark, begin: int, end: int):
    return spark.range(begin, end).select((F.col("id") % 3).alias("slide_id"), (F.col("id") % 8).cast("int").alias("tile_col"), (F.floor(F.col("id") / 8) % 8).cast("int").alias("tile_row"), F.col("id").alias("nucleus_id"))


def test_batches_count_once_and_only_when_done(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tile_table.committed(spark, path) is None
    rows_of(spark, 0, 50).write.partitionBy("slide_id").parquet(f"{path}/data/batch=0")  # left by a failed attempt
    assert tile_table.append_tiles(rows_of(spark, 0, 100), path, 0)
    assert tile_table.append_tiles(rows_of(spark, 100, 150), path, 1)
    assert not tile_table.append_tiles(rows_of(spark, 100, 150), path, 1)
    rows_of(spark, 900, 950).write.partitionBy("slide_id").parquet(f"{path}/data/batch=2")  # failed, not tried again yet
    found = tile_table.read_tiles(spark, path)
    assert sorted(r["nucleus_id"] for r in found.collect()) == list(range(150))
    assert {r["tile_key"] for r in found.filter("nucleus_id = 21").collect()} == {"0_5_2"}
    assert sum(r["n"] for r in tile_table.committed(spark, path).collect()) == 150
    assert tile_table.append_tiles(rows_of(spark, 0, 0), path, 3) and tile_table.read_tiles(spark, path).count() == 150


def test_a_fetch_reads_one_slide_and_pushes_the_tile_down(spark, tmp_path):
    path = str(tmp_path / "t")
    tile_table.append_tiles(rows_of(spark, 0, 2000), path, 0)
    got = tile_table.fetch_tiles(tile_table.read_tiles(spark, path), 1, 3, 4)
    assert {r["nucleus_id"] for r in got.collect()} == {i for i in range(2000) if i % 3 == 1 and i % 8 == 3 and i // 8 % 8 == 4}
    plan = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = [x for x in plan.split("(") if "PartitionFilters" in x and "slide_id" in x]
    assert "PartitionFilters: [isnotnull(slide_id" in plan.replace("#", "") or any("slide_id" in x for x in scan)
    assert "EqualTo(tile_col,3)" in plan and "EqualTo(tile_row,4)" in plan
    near = tile_table.fetch_tiles(tile_table.read_tiles(spark, path), 1, 0, 0, 1)
    assert {(r["tile_col"], r["tile_row"]) for r in near.collect()} == {(c, r) for c in (0, 1) for r in (0, 1)}


def test_files_go_with_rows_and_not_with_slides(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = rows_of(spark, 0, 3000).withColumn("slide_id", F.col("nucleus_id") % 200)
    assert tile_table.append_tiles(rows, path, 0)
    assert len(list((tmp_path / "t" / "data").rglob("*.parquet"))) < 64 + 2 * 8
    got = tile_table.fetch_tiles(tile_table.read_tiles(spark, path), 33, 1, 4)
    assert {r["nucleus_id"] for r in got.collect()} == {i for i in range(3000) if i % 200 == 33 and i % 8 == 1 and i // 8 % 8 == 4} != set()
