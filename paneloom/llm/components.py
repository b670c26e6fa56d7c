"""Connected components of an edge table, every round stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.store import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b): component is the smallest node reachable.

    Each round, a node takes the smallest label among its neighbours' labels and its own, and then
    the label of that label, so that long chains shorten by half. Edges inside a component are
    dropped from round to round; the rest are drawn between labels. Hot nodes are aggregated
    map-side. The number of rounds grows with the logarithm of the longest chain.
    """
    live = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = materialise(live.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while not live.isEmpty():
        # Of the labels that live edges join, each takes the smallest it is joined with, itself included.
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("old")).agg(F.least(F.min("b"), F.first("a")).alias("new"))
        hooked = materialise(hooked, "hooks")
        jump = hooked.select(F.col("old").alias("via"), F.col("new").alias("beyond"))
        short = hooked.join(jump, F.col("new") == F.col("via"), "left").select("old", F.coalesce("beyond", "new").alias("new"))
        short = materialise(short, "jumps")
        labels = materialise(
            labels.join(short, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component")), "labels"
        )
        ends = {side: short.select(F.col("old").alias(f"old_{side}"), F.col("new").alias(f"new_{side}")) for side in "ab"}
        moved = live.join(ends["a"], F.col("a") == F.col("old_a")).join(ends["b"], F.col("b") == F.col("old_b"))
        live = materialise(
            moved.where("new_a <> new_b").select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), "edges"
        )
    return labels
