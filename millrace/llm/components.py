"""Connected components of a graph kept as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import dropped, stored

MAX_ROUNDS = 64


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges`` (a, b: long).

    Alternates the large-star and small-star steps until the edges no longer change; every
    component is then a star around its smallest node. A step is a partial aggregate and a
    join, whose small side is written first, so that the join may split the rows of a node
    with very many edges. Nodes without an edge to another one, and edges with a null end, do
    not appear. The rounds grow with the logarithm of the longest path; running out of them
    is an error, never a partial result. The driver sees two numbers a round.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .distinct(), "edges")
    seen = _fingerprint(current)
    for _ in range(MAX_ROUNDS):
        large, least_of_all = _large_star(current)
        small, least_of_smaller = _small_star(large)
        before, current = current, stored(small, "edges")
        dropped(before, least_of_all, least_of_smaller)
        now = _fingerprint(current)
        if now == seen:
            stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
        seen = now
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every larger neighbour of a node is tied to the smallest node around it; and the table of those."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    tied = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.distinct(), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them; and the table of those."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    others = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), least
