"""Connected components of a large graph by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitegrade.llm.common import stored


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``node, label`` for every end of ``edges`` (``a, b``); the label is the smallest node of the component.

    Each round a node takes the smallest label of itself and its neighbours,
    and then the label of that label, so long chains shrink by half a round.
    Minima are taken before each shuffle, so a node with a third of all edges
    is no hot spot.  Every round is written to the shared folder.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct()
    both = stored(both, folder, "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = stored(labels.select("node", F.least("node", "near").alias("label")), folder, "labels-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("closer"))
        jump = labels.select(F.col("node").alias("closer"), F.col("label").alias("far"))
        after = closer.join(jump, "closer", "left").select("node", F.coalesce("far", "closer").alias("label"), "before")
        after = stored(after, folder, f"labels-{turn}")
        labels = after.select("node", "label")
        if after.where("label <> before").isEmpty():
            return labels
