"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def _edges(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _digest(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), check).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return (
        joined.where("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
    )


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for each node that is not a root.

    Each round keeps the components and brings nodes nearer to their root, in few rounds
    also along chains; the loop ends when a round changes nothing. Minima are taken per task before a shuffle, and a hub's links lie in a sort-merge
    join that Spark splits, so one node may have any number of links. Links from a
    node to itself are ignored.
    """
    edges = cut(links.where(F.col(a) != F.col(b)).select(*_edges(a, b)).distinct())
    before = _digest(edges)
    while before[0]:
        edges = cut(_small_star(_large_star(edges).distinct()).distinct())
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
