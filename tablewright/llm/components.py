"""Connected components of an undirected graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (a, b: bigint; loops are ignored).

    Each round every node points to its smallest neighbour, pointers are followed once more, and edges are drawn
    between the nodes pointed to; what is left shrinks at least by half.  Only counts reach the driver.  A node with
    many edges is summed before it is shuffled and split where it is joined.
    """
    edges = stored(_plain(edges), "cc-edges")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        points = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to"))
        points = stored(points, "cc-points")
        after = points.select(F.col("node").alias("to"), F.col("to").alias("further"))
        points = stored(points.join(after, "to").select("node", F.col("further").alias("to")), "cc-points")
        if labels is None:
            labels = points.select("node", F.col("to").alias("component"))
        else:
            moved = points.select(F.col("node").alias("component"), "to")
            labels = stored(labels.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "cc-labels")
        to = lambda side: points.select(F.col("node").alias(side), F.col("to").alias(f"{side}_to"))
        edges = stored(_plain(edges.join(to("a"), "a").join(to("b"), "b").select(
            F.col("a_to").alias("a"), F.col("b_to").alias("b"))), "cc-edges")
        if edges.isEmpty():
            return labels


def _plain(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
