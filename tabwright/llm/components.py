"""Connected components of an edge list, by alternating large-star and small-star steps.

A large-star step hangs the larger neighbours of every node under its smallest neighbour, a small-star
step does the same with the smaller ones and the node itself. Both keep the components; repeated in
turn, they end in stars around the smallest node of each component, after a number of rounds that
grows with the logarithm of the longest path. Smallest neighbours are combined before the shuffle, so
a node with very many edges is one row per task there; the join that follows leaves large keys to
adaptive execution. Every round is written to the shared folder, and the one before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.sources.durable import drop_copy, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """One row (node, component) per node of an edge list (a, b); the smallest node names a component.

    Loops, repeated edges and edges with a null end are fine: the first two change nothing and the last
    are left out. Nodes without an edge to another node are not in the result. No edges, no rows.
    """
    now = materialise(edges.select("a", "b").where("a <> b").distinct())
    state = _state(now)
    while state[0]:
        large = materialise(_large_star(now))
        small = materialise(_small_star(large))
        drop_copy(now)
        drop_copy(large)
        now, before, state = small, state, _state(small)
        if state == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
