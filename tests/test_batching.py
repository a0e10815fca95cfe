"""Requests in batches and exact progress: the replayed table by hand, and streams against it."""

from __future__ import annotations

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from nucleispark.operators import tiles
from nucleispark.streaming import batching, requests

BEGIN = datetime.datetime(2024, 5, 1)


def made(n: int = 400, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    at, rows = 0.0, []
    for i in range(n):
        at += rng.choice([0.0, 0.01, 0.05, 0.4, 1.5])
        rows.append((i, BEGIN + datetime.timedelta(seconds=round(at, 3)), rng.choice([0, 0, 0, 1, 2]), rng.randrange(4), rng.randrange(4)))
    return rows


def by_hand(rows: list[tuple], size: int, seconds: float) -> dict[int, tuple[int, int, int]]:
    out, state = {}, {}
    for event, ts, slide, _, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        first, n, number = state.get(slide, (None, 0, 0))
        if first is None or n == size or ts >= first + datetime.timedelta(seconds=seconds):
            first, n, number = ts, 0, number + 1
        state[slide] = first, n + 1, number
        out[event] = slide, number, n + 1
    return out


@pytest.fixture
def small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_replayed_table(spark, small_batches):
    rows = made()
    table = spark.createDataFrame([*rows, (9999, None, 0, 0, 0)], requests.SCHEMA).withColumns({"batch": F.lit("clash"), "place": F.lit(0)})
    got = {r["event_id"]: (r["slide_id"], r["batch"], r["place"]) for r in batching.batched_requests(table.repartition(5), 8, "1 second").collect()}
    want = by_hand(rows, 8, 1)
    assert got == want
    assert {n for _, _, n in want.values()} == set(range(1, 9)) and len({(s, b) for s, b, _ in want.values()}) > 60
    assert batching.batched_requests(table.filter("slide_id > 9"), 8).count() == 0


def files(spark, rows: list[tuple], folder, per_file: int) -> str:
    for i in range(0, len(rows), per_file):
        spark.createDataFrame(rows[i : i + per_file], requests.SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.05)
    return f"{folder}/in"


def test_a_stream_by_event_time_is_the_replay(spark, tmp_path):
    rows = sorted(made(160, 4), key=lambda r: (r[1], r[0]))
    rows = [r for i, r in enumerate(rows) if i == 0 or r[1] > rows[i - 1][1]]  # a time belongs to one batch of files
    source = requests.read_requests(spark, files(spark, rows, tmp_path, 40), 1)
    found = batching.stream_batches(source, 8, "1 second", event_time=True)
    run = found.writeStream.format("memory").queryName("batched").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    run.awaitTermination()
    got = {r["event_id"]: (r["slide_id"], r["batch"], r["place"]) for r in spark.table("batched").collect()}
    want = by_hand(rows, 8, 1)
    assert got.items() <= want.items()
    end, sizes, begins = rows[-1][1], {}, {}
    for event, ts, slide, _, _ in rows:
        key = want[event][:2]
        sizes[key] = sizes.get(key, 0) + 1
        begins.setdefault(key, ts)
    waiting = {k for k in sizes if sizes[k] < 8 and begins[k] + datetime.timedelta(seconds=1) > end - datetime.timedelta(milliseconds=1)}
    assert {want[e][:2] for e in want.keys() - got.keys()} <= waiting and len(got) > 100


def test_a_stream_by_the_clock(spark, tmp_path):
    """Full batches go at once, the rest when it has waited."""
    rows = [(i, BEGIN, 5, i % 4, 0) for i in range(20)] + [(100 + i, BEGIN, 6, i, 0) for i in range(3)]
    source = requests.read_requests(spark, files(spark, rows, tmp_path, 50), 1)
    sizes = []

    def seen(batch, number):
        sizes.append((time.time(), sorted((r["slide_id"], r["batch"], r["n"]) for r in batch.groupBy("slide_id", "batch").agg(F.count("*").alias("n")).collect())))

    run = batching.stream_batches(source, 8, "2 seconds").writeStream.foreachBatch(seen).outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
    until = time.time() + 90
    while time.time() < until and sum(n for _, b in sizes for _, _, n in b) < 23:
        time.sleep(0.2)
    run.stop()
    some = [(t, b) for t, b in sizes if b]
    assert some[0][1] == [(5, 1, 8), (5, 2, 8)]
    assert sorted(x for _, b in some[1:] for x in b) == [(5, 3, 4), (6, 1, 3)]


def test_progress_is_exact(spark, tmp_path):
    rows = made(200, 9)
    source = requests.read_requests(spark, files(spark, rows, tmp_path, 60), 1)
    run = batching.exact_progress(source, 16).writeStream.format("memory").queryName("exact").outputMode("update").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    run.awaitTermination()
    got = {r["slide_id"]: (r["finished"], r["share"]) for r in spark.table("exact").groupBy("slide_id").agg(F.max("finished").alias("finished"), F.max("share").alias("share")).collect()}
    plan = spark.range(3).select(F.col("id").alias("slide_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("tile_col")).withColumn("tile_row", F.explode(F.sequence(F.lit(0), F.lit(3))))
    want = {r["slide_id"]: (r["finished"], r["share"]) for r in tiles.progress(plan, spark.createDataFrame(rows, requests.SCHEMA)).collect()}
    assert got == want


def test_progress_that_forgets(spark, tmp_path):
    source = requests.read_requests(spark, files(spark, [(i, BEGIN, 5, i % 3, 0) for i in range(9)], tmp_path, 9), 1)
    seen = []
    run = batching.exact_progress(source, 16, "1 hour").writeStream.foreachBatch(lambda b, _: seen.extend(map(tuple, b.collect()))).outputMode("update").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
    until = time.time() + 60
    while time.time() < until and not seen:
        time.sleep(0.2)
    run.stop()
    assert seen == [(5, 3, 3 / 16)]
