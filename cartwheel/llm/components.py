"""Connected components of an edge table, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _least(edges: DataFrame) -> DataFrame:
    """For each ``u`` the least of its neighbours ``v`` and itself."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _state(edges: DataFrame) -> tuple:
    """What tells two edge tables apart, without sums of ids, which can overflow."""
    return tuple(edges.agg(F.count("*"), *(F.bit_xor(F.xxhash64(F.lit(seed), "u", "v")) for seed in (1, 2))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component``: the smallest id reachable, for every id on an edge.

    Alternating large-star and small-star steps (union-find done by joins)
    until no edge changes.  Each step is one min-aggregate, which combines
    before the shuffle, and one equi-join with its result, where AQE can split
    the rows of a much linked node.  The lineage is cut after every round.
    An empty edge table gives an empty result; repeated edges, edges in either
    direction and loops are fine."""
    e = edges.select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v"))
    e = checkpoint(e.filter("u > v").distinct())
    before = _state(e)
    while before[0]:
        # large star: every larger neighbour of u is hung below the least of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are hung below the least of them
        low = large.join(_least(large), "u")
        small = low.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = checkpoint(small.filter("u > v").distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    # every edge now leads from a node to the root of its star
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
