"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node that has a link; the label is the smallest node it can reach.

    Each round takes the smallest label among the neighbours and then follows labels to their own labels, so
    the rounds grow with the logarithm of a component's width. A round is a written table. Links from a node to
    itself and repeated links do no harm; null ends are ignored; no links give an empty table.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = written(ends.unionByName(ends.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        reached = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        near = labels.join(reached, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = written(near.join(jump, "label", "left").select("node", "old", F.least("label", "next").alias("label")), "labels")
        labels = moved.drop("old")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels
