"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.session import checkpointed as cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b): root is the least node that a chain of edges leads to.

    Alternates large-star and small-star steps until every node hangs on its root. A step moves each edge once, and its
    aggregates combine before they shuffle. Minima are checkpointed before they meet their edges, so that both sides of the
    join are plain shuffles and Spark can split a hub's edges over tasks. Null ends and loops are no edges; no edges
    give no rows.
    """
    now = cut(edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    was = None
    while (is_now := now.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first()) != was:
        was = is_now
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(now.select("hi", "lo"))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").filter("v <> m").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        now = cut(low.select(F.col("m").alias("lo"), F.col("u").alias("hi")).union(small).distinct())
    hung = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return hung.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
