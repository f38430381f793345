"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statlake.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node of the component, for every node of ``links`` (a, b).

    Each round takes the least label among the neighbours, then the label of the label,
    so chains halve. Every round is written to the shared folder. No links: no rows.
    """
    both = kept(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                  .withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near")))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("to"))
        after = labels.select(F.col("node").alias("to"), F.col("label").alias("jump"))
        new = kept(step.join(after, "to").select(
            "node", F.least("to", "jump").alias("label"), (F.least("to", "jump") != F.col("was")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels
