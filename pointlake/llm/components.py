"""Connected components of links by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return (
        both.where("b > a").join(low, "a")
        .select(F.least("b", "low").alias("a"), F.greatest("b", "low").alias("b")).where("a != b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    low = edges.groupBy("b").agg(F.min("a").alias("low"))
    moved = edges.join(low, "b")
    return moved.select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a != b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either linked to one smaller node, or only to larger ones."""
    end = lambda side, up: F.struct(F.col(side).alias("node"), F.lit(up).alias("up"))
    ends = edges.select(F.explode(F.array(end("a", 0), end("b", 1)))).select("col.*")
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return ends.where("up > 1 OR up = 1 AND n > 1").isEmpty()


def connected(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of a link ``a, b``; the label is the smallest node joined.

    Each round writes its links to the shared folder; rounds grow with the logarithm of
    the longest chain. They end when links are stars, which a round would not change.
    """
    edges = written(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "links"
    )
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    )
