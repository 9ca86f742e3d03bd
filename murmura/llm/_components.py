"""Connected components over an edge table, without gathering anything on the driver."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm._store import discard, table


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, label): label is the smallest node reachable.

    Minimum labels spread over the edges and labels are followed to their own label (pointer jumping), so the
    number of rounds follows the logarithm of the longest path. Aggregates combine before the shuffle, so a hub
    costs one row per task. Every round is a table in the shared folder.
    """
    both = table(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "edges")
    labels = table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l")))
        spread = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = table(
            spread.join(jump, "label", "left")
            .select("node", F.least("label", "up").alias("label"), "old"), "labels")
        changed = after.where("label <> old").limit(1).count()
        discard(labels)
        labels = after.select("node", "label")
        if not changed:
            return labels
