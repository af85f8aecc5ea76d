"""Connected components of an edge list, by alternating star contraction.

Each round points every node's larger neighbours at its least neighbour, then its smaller ones; a
path halves and a star is done at once. Rounds end when nothing changes. Each round's edges are
written to the shared folder, which cuts the plan and survives lost executors; a node with very
many edges meets only a partial minimum and a join that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(u, v) for each node u that is not the least of its component v. ``edges``: u, v of any orderable type."""
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = settle(edges.where(F.col("u") != F.col("v")).select(high.alias("u"), low.alias("v")).distinct())
    before, now = None, _print(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        moved = large.join(least, F.col("u") == F.col("w")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(moved.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())
        before, now = now, _print(edges)
    return edges
