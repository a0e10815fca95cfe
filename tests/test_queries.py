"""Every query of the slide library against its DuckDB counterpart, or for those that SQL can't express, that it has rows."""

from __future__ import annotations

import pytest
from compare import differences

from nucleispark.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    if name in catalog.ORACLES:
        assert differences(df, catalog.ORACLES[name], FOLDER) == ""
    else:
        assert df.count() > 0


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("block", [300, 100_000])
def test_nms_in_rounds_is_greedy_nms(spark, block):
    """One pass over a whole slide, in a single group, keeps the same boxes as rounds over blocks, which are few for large blocks."""
    from pyspark.sql import functions as F

    from nucleispark.operators import nms
    from nucleispark.plans.fixtures import table

    dets = table(spark, FOLDER, "detections")
    chain = spark.range(100).select(F.lit(7).cast("long").alias("slide_id"), F.col("id").alias("nucleus_id"), (F.col("id") * 10.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("id") * 10.0 + 15).alias("x1"), F.lit(9.0).alias("y1"), F.lit(1).alias("label"), (1 - F.col("id") / 1000).alias("score"))
    every = dets.select(*chain.columns).unionByName(chain).withColumns({"status": F.lit("clash"), "better": F.lit(0)})
    once = {tuple(r) for r in nms.nms_by_group(every, ["slide_id"], 0.1).select("slide_id", "nucleus_id").collect()}
    kept, rounds = nms.suppress_slides(every, 0.1, 64, block)
    assert {tuple(r) for r in kept.select("slide_id", "nucleus_id").collect()} == once and 0 < len(once) < every.count() and kept.columns == every.columns
    assert rounds == 1 if block > 4096 else 1 < rounds < 9  # the chain is 1005 pixels and 100 boxes long
