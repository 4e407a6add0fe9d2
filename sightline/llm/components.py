"""Connected components of an edge table, by alternating star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import stage

#: Nodes up to which the smallest neighbours of all are broadcast (16 bytes each).
BROADCAST_NODES = 1 << 16


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    joined = both.filter(F.col("v") > F.col("u")).join(F.broadcast(low) if small else low, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(F.broadcast(low) if small else low, "u")
    # One of a node's edges leads to the smallest already: it stays as it is.
    kept = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return joined.select(kept.alias("u"), F.col("m").alias("v"))


def _nodes(edges: DataFrame) -> tuple[int, int]:
    """How many nodes there are, and how many of them break the stars.

    Edges are stars if every node has one smaller neighbour at most, and that one none.
    """
    ends = edges.select(F.col("u").alias("node"), "v").union(edges.select(F.col("v").alias("node"), "v"))
    lows = ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    nodes, broken = lows.agg(F.count("*"), F.count_if(F.col("low") != F.col("high"))).first()
    return nodes, broken


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges ``(a, b)``; the root is the smallest node.

    Each round writes the edges to the shared folder, so a lost executor costs at most
    one round, and the number of edges never grows. Rounds grow with the logarithm of
    the longest path; edges that are stars need none. The driver sees two numbers a
    round, and of small graphs a row for each node. Edges with a null end or equal ends
    are ignored; no edges give no rows.
    """
    current = edges.filter(F.col("a") != F.col("b"))
    current = current.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = stage(current, "edges")
    while True:
        nodes, broken = _nodes(current)
        if not broken:
            break
        small = nodes <= BROADCAST_NODES
        current = stage(_small_star(_large_star(current, small), small).distinct(), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
