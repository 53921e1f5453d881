"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of ``links (a, b)``: the smallest node
    that any chain of links reaches.

    Each round, a node takes the smallest label among its own and its neighbours',
    then the label of that label; labels only fall, so it ends. Every round is
    written, which cuts the lineage. No links give no rows.
    """
    edges = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    )
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        offered = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("offered"))
        )
        near = labels.join(offered, "node").select("node", "component", F.least("component", "offered").alias("near"))
        further = labels.select(F.col("node").alias("near"), F.col("component").alias("further"))
        moved = stored(
            near.join(further, "near").select(
                "node", F.least("near", "further").alias("component"), (F.least("near", "further") < F.col("component")).alias("fell")
            )
        )
        labels = moved.select("node", "component")
        if moved.where("fell").isEmpty():
            return labels
