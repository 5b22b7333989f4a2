"""Connected components of a table of links.

Every node takes the smallest label among its neighbours, then the label of its label
(pointer jumping), until nothing changes. Each round is written to the cluster's
shared folder, so the lineage stays short and a lost executor repeats little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.staging import stage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); label: smallest node reachable."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.where("a <> b").distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("heard")), "b")
        heard = heard.groupBy(F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        hooked = labels.join(heard, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("near")
        )
        # The label is a node too; take its label, from before this round.
        farther = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        moved = hooked.join(farther, "near", "left").select(
            "node", F.least("near", "far").alias("label"), (F.least("near", "far") != F.col("old")).alias("changed")
        )
        moved = stage(moved)
        labels = moved.select("node", "label")
        if moved.where("changed").limit(1).count() == 0:
            return labels
