"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import cut


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, label): the least node reachable; only nodes with edges.

    Every round takes the least label of the neighbours and then the label's own label,
    so that chains shorten by half or more.  Rounds end when nothing changes.
    """
    both = cut(
        edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        met = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("far"))
        new = cut(met.join(jump, "lower", "left").select("node", F.col("label").alias("old"), F.least("lower", "far").alias("label")))
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels
