"""Connected components over an edge table, by alternating large and small stars.

Each round is two shuffled passes over the edges, and every round is written to the shared
folder. The number of rounds grows with the logarithm of the longest chain. A hub's edges are
never gathered: its smallest neighbour is found by a pre-aggregated minimum and joined back
as a written lookup, so that a hot hub's edges can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    lowest = stage(both.groupBy("a").agg(F.min("b").alias("low")), "stars")
    lowest = lowest.select("a", F.least("a", "low").alias("low"))
    moved = both.join(lowest, "a")
    if large:
        out = moved.where("b > a").select(F.col("low").alias("a"), "b")
    else:
        out = moved.select(F.col("low").alias("a"), "b").unionByName(lowest.select(F.col("low").alias("a"), F.col("a").alias("b")))
    return out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node with an edge (``a``, ``b``: longs); root is the smallest node."""
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stage(edges, "edges")
    mark = _mark(edges)
    while True:
        edges = stage(_star(stage(_star(edges, True), "edges"), False), "edges")
        mark, before = _mark(edges), mark
        if mark == before:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
