"""Connected components by contraction: joins and grouped aggregates, a checkpoint each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); nodes share a root when linked.

    Each round every node joins its neighbour of the lowest hash, itself included, and the graph
    is contracted to those neighbours.  The hash order makes the number of rounds logarithmic
    for any shape of graph, long chains included.  Self-links only add their node.  An empty
    frame gives an empty frame; null ends are dropped.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct()
    edges = cut(edges)
    nodes = cut(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                .select("node", F.col("node").alias("root")))
    edges = edges.where("a <> b")
    while not edges.isEmpty():
        ends = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        best = (ends.groupBy("a").agg(F.min(rank("b")).alias("m"))
                .select(F.col("a").alias("was"), F.least(rank("a"), F.col("m"))["v"].alias("now")))
        best = cut(best)
        nodes = cut(nodes.join(best, nodes["root"] == best["was"], "left")
                    .select("node", F.coalesce("now", "root").alias("root")))
        left, right = best.toDF("a", "x"), best.toDF("b", "y")
        edges = cut(edges.join(left, "a").join(right, "b").where("x <> y")
                    .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return nodes
