"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for all ends of ``edges`` (``u``, ``v``).

    A round takes the smallest label among a node and its neighbours and then the label of that label, so labels
    travel twice as far each round. Labels are checkpointed every round; only the count of changes reaches the
    driver. An empty edge table gives an empty result; loops and repeated edges do no harm.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct().checkpoint()
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    labels = labels.select("node", F.least("node", "label").alias("label")).checkpoint()
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        new = low.join(up, "low").select("node", "old", F.least("low", "up").alias("label")).checkpoint()
        changed = new.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
