"""Connected components of a graph given by edges, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and an equi-join in which hubs do not meet in one task, so
nothing is collected and a hub with any number of neighbours is only rows; the edges are written after every step to cut
the lineage, and those of the step before go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_unique, saved


def _towards_least(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (u, v) with m, the least of u and all v of u."""
    least = scratch.keep(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"), "n"))
    return join_unique(pairs, "u", least, "w", "n").select("u", "v", "m")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges: u, v (long, not null), repeats and self-loops allowed.  Returns node, root for every node that is not
    its component's least; an empty graph gives an empty result."""
    scratch = Scratch(edges.sparkSession)
    edges = scratch.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    seen = _mark(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = scratch.keep_only(_towards_least(both, scratch).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())
        small = _towards_least(large, scratch)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = scratch.keep_only(small.filter("u > v").distinct())
        if (now := _mark(edges)) == seen:
            out = saved(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
            scratch.drop()
            return out
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
