"""Connected components of an edge table, by label propagation with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``node, label``: the least node of each component, for every
    node with an edge.  A round takes the least label among a node's neighbours
    (aggregated before the shuffle, so hubs are no hot keys) and follows labels one
    step further; rounds end when no label changes.  Tables stay distributed, and
    each round's labels are written to the shared folder."""
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = durable(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = durable(nearer.join(jump, "label", "left").select("node", "old", F.least(F.coalesce("next", "label"), "label").alias("label")))
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels
