"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of `edges` (a, b): the label is the component's smallest node.

    Each round a node takes the smallest label around it and then that label's own label, so chains shrink by half
    or better. Labels are combined before they are shuffled: a node with many edges is a few rows per task.
    """
    edges = edges.where("a != b").select("a", "b")
    both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"))
    table = labels = materialize(labels, "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        next_of = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        lower = lower.join(next_of, "label").select("node", "old", F.least("label", "beyond").alias("label"))
        lower = materialize(lower, "labels")
        discard(table)
        table, labels = lower, lower.select("node", "label")
        if lower.where("label != old").isEmpty():
            discard(both)
            return labels
