"""Connected components of a link table, as Spark joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``links`` (a, b).

    Each round a node takes the smallest label among its neighbours' and then
    the label of that label, so labels jump over long chains; labels only fall, so the rounds end.  Labels are
    written to the shared folder each round; nothing is collected but a count.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a <> b").distinct()
    both = staged(both, "links")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("theirs")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs")))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"),
                                                 F.least("component", "theirs").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = staged(lower.join(jump, "component").select("node", "old", F.col("further").alias("component")), "labels")
        changed = moved.filter("old <> component").limit(1).count()
        labels = moved.select("node", "component")
        if not changed:
            return labels
