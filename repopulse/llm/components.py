"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b): label is the smallest node reachable.

    Each round takes the least label of a node, its neighbours and its label's label, so a chain
    halves in every round. Nodes with very many links are reduced on the map side; labels that very
    many nodes share are joined by a plain equi-join, which adaptive execution splits.
    """
    arcs = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    arcs = arcs.union(arcs.select("other", "node")).where("node <> other").distinct()
    arcs = cut_lineage(arcs)
    first = arcs.groupBy("node").agg(F.min("other").alias("other"))
    labels = cut_lineage(first.select("node", F.least("node", "other").alias("label")))
    while True:
        heads = labels.select(F.col("node").alias("head"), F.col("label").alias("top"))
        reach = arcs.join(heads.withColumnRenamed("head", "other"), "other")
        around = reach.groupBy("node").agg(F.min("top").alias("near"))
        nearer = labels.join(around, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("head")
        )
        jumped = nearer.join(heads, "head").select(
            "node", F.least("head", "top").alias("label"), "was"
        )
        jumped = cut_lineage(jumped)
        labels = jumped.select("node", "label")
        if jumped.where("label <> was").isEmpty():
            return labels
