"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.sources.lineage import cut_lineage, drop_state


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for the nodes of ``links`` (a, b).

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label, so labels travel in doubling steps. Once no node
    has a neighbour with a smaller label, all of a component have one. Labels
    are combined before they are shuffled; rounds write their state and delete
    the one before.
    """
    both = cut_lineage(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select("b", "a"))
        .where("node <> other")
        .distinct()
    )
    labels = cut_lineage(
        both.groupBy("node").agg(F.min("other").alias("low"))
        .select("node", F.least("node", "low").alias("component"))
    )
    while True:
        told = both.join(
            labels.select(F.col("node").alias("other"), "component"), "other"
        ).select("node", "component", F.lit(None).cast("bigint").alias("before"))
        own = labels.select("node", "component", F.col("component").alias("before"))
        nearer = cut_lineage(
            told.union(own).groupBy("node").agg(F.min("component").alias("component"), F.max("before").alias("before"))
        )
        drop_state(labels)
        if not nearer.agg(F.max(F.col("component") != F.col("before")).alias("moved")).first()["moved"]:
            drop_state(both)
            return nearer.select("node", "component")
        jump = nearer.select(F.col("node").alias("_n"), F.col("component").alias("_far"))
        labels = cut_lineage(
            nearer.join(jump, F.col("component") == F.col("_n")).select("node", F.col("_far").alias("component"))
        )
        drop_state(nearer)
