"""Connected components of a large graph of numbers, round by round in shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import materialise


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that links lead to) of every node of links (a, b).

    Each round takes the smallest label of the neighbours and then the label's own label, so the
    rounds grow with the logarithm of the longest path. All groups are minima, combined before
    the shuffle; a node with very many links is split by the join, and nothing is collected.
    Links are computed once and written where they are found; one that comes several times costs
    work, but changes no minimum.
    """
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(links.select(F.inline(both)), "edges")
    # The first round takes these three times from one shuffle, as all have the same filter.
    labels = edges.filter("a is not null").groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component"))
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("component").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.least("component", "near").alias("low"), F.col("component").alias("before"))
        jump = labels.select(F.col("node").alias("over"), F.col("component").alias("further"))
        after = materialise(low.join(jump, F.col("low") == F.col("over"), "left").select(
            "node", F.least("low", "further").alias("component"), "before"), "labels")
        if after.filter(F.col("component") != F.col("before")).isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
