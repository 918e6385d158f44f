"""Connected components by label propagation with pointer jumping, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b); ``component`` is the smallest node that can be reached.

    Each round takes the smallest label of the neighbours and then the label of the own label, so long chains
    need few rounds. Labels are written after each round; no task holds a component.
    """
    edges = edges.where(F.col("a") != F.col("b"))
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("_m")).select(
        F.col("a").alias("node"), F.least("a", "_m").alias("component")), "labels")
    while True:
        heard = both.join(labels, both["a"] == labels["node"]).groupBy("b").agg(F.min("component").alias("heard"))
        lower = labels.join(heard, labels["node"] == heard["b"]).select(
            "node", F.least("component", "heard").alias("to"), (F.col("heard") < F.col("component")).alias("moved")
        )
        lower = stored(lower, "labels")
        target = lower.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
        jumped = lower.join(target, lower["to"] == target["_node"]).select(
            "node", F.least("to", "_to").alias("component"), (F.col("moved") | (F.col("_to") < F.col("to"))).alias("moved")
        )
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("moved").isEmpty():
            return labels
