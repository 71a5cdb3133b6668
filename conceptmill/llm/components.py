"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger end a to its smaller end b."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node with the smallest of that node and its neighbours.

    The smallest neighbour comes from an aggregation and a join, not from a list, so a
    node may have any number of neighbours.
    """
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    pairs = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return edges.join(least, "a").select(F.explode(pairs).alias("e")).select("e.a", "e.b")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge down and is nobody's smaller end; the steps then change nothing."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("down")))
    nodes = edges.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.down").alias("edges"), F.min("e.down").alias("least"))
    return nodes.where("edges > 1 OR (edges = 1 AND least = 0)").count() == 0


def stars(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(a, b): every node that is not the smallest of those it is connected to, with that smallest one.

    ``edges`` has columns a and b of one comparable type, none null. A large-star step links
    larger neighbours to the smallest one, a small-star step the smaller ones; both together
    end in stars after a number of rounds that grows with the logarithm of the size. What each
    step returns is a table in the shared folder, so no plan holds more than one step.
    """
    edges = written(_downward(edges), "edges")
    for _ in range(max_rounds):
        if _are_stars(edges):
            return edges
        low = written(_downward(_large_star(edges)), "edges")
        edges = written(_downward(_small_star(low)), "edges")
    if not _are_stars(edges):
        raise RuntimeError("components did not settle")
    return edges


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component): every node of an edge with the smallest node it is connected to; see ``stars``."""
    edges = stars(edges, max_rounds)
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return inner.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
