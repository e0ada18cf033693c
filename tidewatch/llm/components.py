"""Connected components of a graph given as rows, by alternating star steps.

A large star step points every larger neighbour of a node at the node's smallest one, a small star step the smaller ones and the
node itself; in a logarithmic number of rounds every node points at the smallest of its component. Neighbourhoods are never
gathered: the smallest neighbour is an aggregate that is written and joined back to the edges. As it is read from files, both sides
of that join cross an exchange of their own, so the adaptive skew join splits a hub's rows (an aggregate on the join key would be
joined in place, hub and all).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.storage import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (a, b: long, a <> b): root is the smallest node it is connected with."""
    edges = stage(edges.select("a", "b").distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = stage(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
