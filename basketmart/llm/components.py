"""Connected components of a distributed table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked to over any path. Nodes without links don't appear.

    Each round every node takes the smallest label among its neighbours, then the label of its label, so labels travel
    twice as far each round. Labels live in tables of the shared folder; only the number of changes comes to the driver.
    Repeated links and links in both directions count once; a link of a node with itself keeps it as a node.
    """
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = stored(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        best = edges.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        moved = labels.join(best, "node").select("node", "component", F.least("component", "near").alias("target"))
        jump = labels.select(F.col("node").alias("target"), F.col("component").alias("farther"))
        moved = moved.join(jump, "target", "left").select(
            "node", F.col("component").alias("old"), F.least("target", "farther").alias("component")
        )
        moved = stored(moved)
        labels = moved.select("node", "component")
        if not moved.filter("component < old").agg(F.count("*")).first()[0]:
            return labels
