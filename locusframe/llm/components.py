"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").select(F.col("m").alias("a"), F.col("u").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.unionByName(own).filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))


def connected(edges: DataFrame) -> DataFrame:
    """Nodes of every component of two nodes at least: node, component (its smallest node).

    ``edges`` has u and v (longs, not null); direction, repeats and loops do not matter. The two steps
    alternate until the edges no longer change; the number of rounds grows with the logarithm of the
    longest path. Minima combine before the shuffle, and joins on a hub can be split by Spark.
    """
    current = written(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    print_of = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))]
    seen = tuple(current.agg(*print_of).first())
    while seen[0]:
        current = written(_small_star(_large_star(current).distinct()).distinct(), "edges")
        now = tuple(current.agg(*print_of).first())
        if now == seen:
            break
        seen = now
    members = current.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return members.unionByName(current.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
