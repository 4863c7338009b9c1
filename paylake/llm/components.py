"""Connected components of an edge table, by alternating large and small stars.

Every round is a few shuffles over at most the edges it was given; edges turn
into stars around each component's least node. Nothing is gathered on the
driver but a row count and a checksum per round. The least neighbour of every
node is staged before it is joined back, so a node with very many neighbours
meets a join whose skewed partitions can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from paylake.llm.common import BROADCAST_ROWS, broadcast_if_small, staged


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, small: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = broadcast_if_small(staged(both.groupBy("u").agg(F.min("v").alias("m")), "cc-least"), small)
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    m = F.min("b").over(W.partitionBy("a"))
    least = edges.withColumn("m", m)
    return (least.select("a", F.col("m").alias("b"))
            .union(least.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())


def components(edges: DataFrame, small: int = BROADCAST_ROWS) -> DataFrame:
    """(node, root) of every node that has an edge and is not the least of its
    component, for edges (a, b) of a comparable type; loops and repeats are
    allowed, an empty table gives an empty result. Tables of up to ``small``
    nodes are broadcast."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "cc-edges")
    mark = _mark(edges)
    while mark[0]:
        edges = staged(_small_star(_large_star(edges, small)), "cc-edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
