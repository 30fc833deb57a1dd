"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillgate.llm import common as c


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of ``edges``; the root is the least node.

    Every round, each node links its larger neighbours to its least one and
    then all its smaller ones to the least, so stars form; sums are combined
    before each shuffle, and every round is a written table, so nothing is
    computed twice and a lost executor costs no round.  The rounds end when
    only stars are left.  Null ends are ignored.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs = c.materialise(pairs, "component-edges")
    while not stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = c.materialise(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "component-least")
        # larger neighbours of u to the least around u
        large = pairs.select(F.col("u").alias("x"), F.col("v").alias("u")).join(least, "u").select(F.col("x").alias("u"), F.col("m").alias("v"))
        large = c.materialise(large.filter("u <> v").distinct(), "component-large")
        low = c.materialise(large.groupBy("u").agg(F.min("v").alias("m")), "component-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        pairs = c.materialise(small, "component-edges")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def stars(pairs: DataFrame) -> bool:
    """Whether every node of the distinct pairs (u, v), v < u, either has one
    smaller neighbour and no larger one, or only larger ones."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up + down > 1 and up > 0").limit(1).isEmpty()
