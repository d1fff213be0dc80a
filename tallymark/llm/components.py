"""Connected components of a link table, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import written_once


def _with_least(pairs: DataFrame) -> DataFrame:
    """Directed pairs (u, v) with the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least, "u").withColumn("least", F.least("u", "least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of u below the least node around u."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    return _with_least(both).filter("v > u").select(F.col("v").alias("b"), F.col("least").alias("a"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang u and its smaller neighbours below the least of them."""
    down = _with_least(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    hung = down.select(F.col("v").alias("b"), F.col("least").alias("a"))
    return hung.union(down.select("u", "least")).filter("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge to another; component is the least node.

    `edges` has columns a and b in any order and number. Each round is a few
    shuffles of the edge table, which never grows; rounds follow the logarithm
    of the longest path. Only a count and a checksum reach the driver.
    """
    tidy = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, before = written_once(tidy.filter("a < b").distinct(), "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
        before = state
        edges = written_once(_small_star(_large_star(edges).select("a", "b")), "links")
