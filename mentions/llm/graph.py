"""Connected components by contraction, for links that operators 5 and 6 find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for each end of an edge (``a``, ``b``, longs); a component is named by its smallest node.

    Each round points every node at its smallest neighbour, follows the
    pointers twice, and replaces the ends of each edge by where they point.
    Edges inside a component vanish, so the graph shrinks by a factor each
    round. Minimums are combined map-side, so a node with very many links
    costs a row per task; joins are on ids, which AQE can split.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("to")), "pointers")
        for _ in range(2):
            there = point.select(F.col("node").alias("to"), F.col("to").alias("next"))
            point = point.join(there, "to").select("node", F.col("next").alias("to"))
        point = stored(point, "pointers")
        left = point.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = point.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = stored(edges.join(left, "a").join(right, "b").where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if labels is None:
            labels = point.select("node", F.col("to").alias("component"))
        else:
            moved = point.select(F.col("node").alias("component"), "to")
            labels = stored(labels.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
