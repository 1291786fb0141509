"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least node that it sees."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.where("v > u").join(cut(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the least of them."""
    least = cut(edges.groupBy("u").agg(F.min("v").alias("m")))
    out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for each node of an edge the smallest node that it reaches. Loops, repeats and nulls are ignored.

    Every step is an aggregation by node and a join with its result, which adaptive execution can split for
    nodes of many edges. Rounds follow the logarithm of the number of nodes; each is cut in the shared folder.
    """
    edges = cut(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while True:
        stars = cut(_small_star(cut(_large_star(edges))))
        # done when every node has one edge and none is both an end and a centre
        ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("edges"), F.lit(0).alias("centre")).union(stars.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("edges").alias("edges"), F.max("centre").alias("centre"))
        if not ends.where("edges > 1 or edges = 1 and centre = 1").limit(1).count():
            break
        edges = stars
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
