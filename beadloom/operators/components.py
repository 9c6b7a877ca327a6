"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beadloom.runtime import cut


def linked_table(edges: DataFrame) -> DataFrame:
    """``blk, node, low``: smallest node that a chain of edges ``blk, a, b`` links to each node, by alternating large and small stars.

    Rounds go on until no edge moves, which takes a number of them that grows with the logarithm of the nodes.
    """
    e = cut(edges.select("blk", F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = e.unionByName(e.select("blk", F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("blk", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, ["blk", "u"]).filter("v > u").select("blk", F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.filter("u <> v").distinct())
        low = large.groupBy("blk", "u").agg(F.min("v").alias("m"))
        small = large.join(low, ["blk", "u"]).select("blk", F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("blk", "u", F.col("m").alias("v")))
        e = cut(small.filter("u <> v").distinct())
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
        if now == before:
            break
        before = now
    return e.select("blk", F.col("u").alias("node"), F.col("v").alias("low"))
