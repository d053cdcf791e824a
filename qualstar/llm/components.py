"""Connected components of a graph given as pairs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin, unpin


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges(a, b)``; component is the
    smallest node that can be reached.

    Each round hooks every node's larger neighbours, then its smaller ones, to
    the smallest node of its neighbourhood; rounds grow with the logarithm of
    the longest path.  A node's neighbours are only ever aggregated to their
    minimum and joined back, never gathered; hubs are pre-aggregated by Spark
    on the map side and split by its skew join.  Every round is written out,
    so a lost executor repeats one round at most.
    """
    now = pin(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    while not _stars(now):
        # Large star: larger neighbours of a node point to its smallest neighbour, itself included.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = pin(both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        # Small star: smaller neighbours and the node itself point to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        small = pin(small, name)
        unpin(now, large)
        now = small
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node points to one smaller node that points to none."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))))
    return not (ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
                .filter("out > 1 or (out = 1 and into = 1)").limit(1).count())
