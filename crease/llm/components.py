"""Connected components of links between nodes, by alternating star contraction.

Each round links all larger neighbours of a node to its least neighbour, then all smaller
ones; the links become stars around the least node of each component. All of it is
aggregates and equi joins; a round is stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.session import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); the component is its least node."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Each node now has smaller neighbours only; the least of them takes the others.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.select("a", F.col("m").alias("b")).unionByName(moved).distinct(), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
