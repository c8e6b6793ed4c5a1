"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component: lowest node reachable) of every node of `edges` (a, b), a node being a long.

    Each round every node takes the lowest label among its own and its neighbours', and then the label
    of the node it is labelled by. Labels are written after each round; rounds stop when none changes.
    """
    pairs = edges.select("a", "b")
    both = pairs.union(pairs.select("b", "a")).union(pairs.select("a", "a")).union(pairs.select("b", "b"))
    both = written(both.distinct(), "graph")
    labels = written(both.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node"), "labels")
    total = None
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "component"), "b")
        near = seen.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        jump = labels.select(F.col("node").alias("near"), "component")
        new = written(near.join(jump, "near").select("node", "component"), "labels")
        # Labels only fall, so an equal sum means that none changed.
        before, total = total, new.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        dropped(labels)
        labels = new
        if total == before:
            dropped(both)
            return labels
