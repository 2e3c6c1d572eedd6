"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from planledger.llm.storage import saved
from planledger.operators.joins import split_join


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that each node of an edge can reach.

    Every node takes the smallest label among its neighbours, then its label's own
    label, until nothing changes. Labels are written to the shared folder in each
    round; only the number of changes goes to the driver. A node that has a third
    of all edges is reduced in the map tasks when labels are taken, and its edges
    are divided over tasks when they are looked up. Edges with a null end are ignored.
    """
    ends = edges.select(F.col(a).alias("node"), F.col(b).alias("next")).filter("node is not null and next is not null")
    both = saved(ends.unionByName(ends.select(F.col("next").alias("node"), F.col("node").alias("next"))).distinct(), "edges")
    labels = both.groupBy("node").agg(F.least("node", F.min("next")).alias("label"))
    labels = saved(labels, "labels")
    while True:
        known = labels.select(F.col("node").alias("next"), "label")
        near = split_join(both, known, "next", "inner").groupBy("node").agg(F.min("label").alias("near"))
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        after = split_join(taken, jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("far", "label")).alias("label")
        )
        after = saved(after, "labels")
        if not after.filter("label <> old").limit(1).count():
            return after.select("node", "label")
        labels = after.select("node", "label")
