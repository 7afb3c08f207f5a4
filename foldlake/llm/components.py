"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlake.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them. Edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """a, b for every node a but the smallest of each component, with that smallest node b.

    edges has columns a and b (longs, no nulls); repeated edges, both directions and loops are allowed. Every round ends
    in a written table, and only two numbers come to the driver. Hubs meet in a partial minimum and in joins that
    adaptive execution splits, never in one list.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = common.materialize(now, "edges"), None
    while True:
        count, check = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if (count, check) == seen or not count:
            return now
        seen, before = (count, check), now
        now = common.materialize(_small_star(_large_star(now)), "edges")
        common.drop(before)
