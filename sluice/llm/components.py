"""Connected components of a large edge list, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import written


def hang_larger(edges: DataFrame) -> DataFrame:
    """Large star: the larger neighbours of each node move to its smallest neighbour or itself."""
    seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = seen.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    moved = seen.filter("b > a").join(least, F.col("a") == F.col("node"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def hang_smaller(edges: DataFrame) -> DataFrame:
    """Small star: the smaller neighbours of each node, and itself, move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), "least")
    moved = edges.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).filter("a > b").distinct()


def is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one node, which hangs on none."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("hangs")), F.struct(F.col("b").alias("node"), F.lit(0).alias("hangs"))))
    nodes = edges.select(ends.alias("end")).groupBy("end.node").agg(F.sum("end.hangs").alias("hangs"), F.min("end.hangs").alias("least"))
    return nodes.filter("hangs > 1 or (hangs = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node reachable, for nodes of ``edges(a, b)`` but the smallest themselves.

    Loops and repeated edges do no harm; no edges give no rows. A node with very
    many neighbours is only the key of a combined minimum and of a join. Each
    round is written to the shared folder, and rounds grow with the logarithm of
    the longest chain.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = written(edges, "edges")
    while not is_settled(edges):
        edges = written(hang_smaller(hang_larger(edges)), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
