"""Connected components by alternating stars: every round is two joins and three groupings, nothing leaves Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every node is tied to one other, which is tied to none: then that one is the least node reachable."""
    ends = edges.select("a", F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
    return ends.groupBy("a").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).where("ups > 1 OR ups = 1 AND least = 0").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each larger neighbour of a node to the node's least neighbour (or itself)."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties the smaller neighbours of a node, and the node, to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node reachable) for every node of ``edges`` (two long columns) other than the roots."""
    a, b = edges.columns
    edges = stored(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    while not _stars(edges):  # seen on the edges: no further round is needed to find that nothing changes
        edges = stored(_small_star(_large_star(edges)))
    return edges.toDF("node", "root")
