"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """The smallest node that each node of ``edges`` (a, b: long) can reach: node, component.

    Alternating stars: every node points its larger neighbours, then its smaller ones, at the
    smallest of them, until each component is one star. A round is a few shuffles of what is
    left, a hub's edges are pre-aggregated, and each round ends in a checkpoint in the shared
    folder. Edges from a node to itself and edges with a null are left out; ``edges`` is read several
    times, so pass a written table.
    """
    star = edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    for _ in range(rounds):
        # each neighbour that is larger than a node goes to the node's smallest neighbour
        both = star.unionAll(star.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        larger = star.select(F.col("u").alias("v"), F.col("v").alias("w"))
        large = larger.join(least, "v").select(F.col("w").alias("v"), F.col("m").alias("u"))
        # each node and its smaller neighbours go to the smallest of them; one shuffle by node
        # serves for what follows
        large = large.unionAll(least.filter("m < v").select("v", F.col("m").alias("u"))).repartition("v").dropDuplicates(["v", "u"])
        smallest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(smallest, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        star = small.unionAll(smallest.select("v", F.col("m").alias("u"))).distinct().checkpoint()
        if _settled(star):
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = star.select(F.col("u").alias("node")).distinct()
    return star.select(F.col("v").alias("node"), F.col("u").alias("component")).unionAll(roots.withColumn("component", F.col("node")))


def _settled(star: DataFrame) -> bool:
    """Whether each node is a centre or points at one, and not both."""
    nodes = star.select(F.col("v").alias("node"), F.lit(1).alias("points"), F.lit(0).alias("centre"))
    nodes = nodes.unionAll(star.select("u", F.lit(0), F.lit(1)))
    counted = nodes.groupBy("node").agg(F.sum("points").alias("points"), F.max("centre").alias("centre"))
    return counted.filter("points + centre > 1").isEmpty()
