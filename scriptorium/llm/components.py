"""Connected components of a link table: smallest labels with pointer jumping."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import spread_join, staged


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """links: a, b (long).  Returns node, component (the smallest node reachable)
    for each node with a link.  Each round is a written table, so a lost executor
    costs a round; the rounds grow with the logarithm of the longest path.  Rows of a
    node with many links, and of a component with many nodes, are dealt to several
    tasks.  After so many rounds, where given, components may still be in parts."""
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "node"), "labels")
    for k in count(1):
        near = spread_join(both, labels.withColumnRenamed("node", "b"), "b", "a").groupBy("a").agg(F.min("component").alias("near"))
        lower = staged(labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("was"), F.least("component", "near").alias("component")), "labels")
        up = lower.select(F.col("node").alias("component"), F.col("component").alias("above"))
        labels = staged(spread_join(lower, up, "component", "node").select("node", "was", F.least("component", "above").alias("component")), "labels")
        if k == rounds or not labels.filter("was <> component").limit(1).count():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
