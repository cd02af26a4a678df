"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the smallest of its neighbours and itself."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them. Edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and digest sum, to see whether a round changed anything."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, of every node that has an edge (``a``, ``b``).

    Loops, repeated edges and edges in both directions change nothing. Every round works by joins and
    sums that combine before the shuffle and writes its edges to the shared folder; the number of rounds grows
    with the logarithm of the nodes. An empty table gives an empty result.
    """
    linked = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    linked = stage_table(linked, "edges")
    before = _state(linked)
    while before[0]:
        linked = stage_table(_small_star(_large_star(linked)), "edges")
        after = _state(linked)
        if after == before:
            break
        before = after
    roots = linked.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return linked.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
