"""Connected components of links, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import removed, written


def connected(links: DataFrame, folder: str) -> DataFrame:
    """``(node, component)`` for each node of ``links(a, b)``; the component is its smallest node.

    Alternates large-star and small-star rounds (Kiveris and others, 2014). The minimum of a
    node's neighbours is combined before the shuffle, and the join back can be split by AQE,
    so a node with very many links is no hot group. Every round starts from written files.
    NULL ends and self links are ignored.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, f"{folder}/round-0")
    state = _state(edges)
    n = 0
    while state[0]:
        n += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        edges = written(small, f"{folder}/round-{n}")
        removed(spark, f"{folder}/round-{n - 1}")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them; a round that changes neither has ended."""
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]
