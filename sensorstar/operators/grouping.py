"""Topics to groups and tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorstar.functions.text import TABLE_KEYWORDS
from sensorstar.operators.numbering import number_rows
from sensorstar.session import literal_rows

NAME_PARTS = 3


def manual_groups(spark: SparkSession, groups: Mapping[int, Iterable[str]], fused: Iterable[int] = ()) -> DataFrame:
    """``(group_id, topic)`` from a given map; the ids in ``fused`` become one group."""
    together = [g for g in groups if g in set(fused)]
    name = "_".join(str(g) for g in together)
    rows = {(name if g in together else str(g), topic) for g, topics in groups.items() for topic in topics}
    return literal_rows(spark, "group_id string, topic string", sorted(rows))


def in_groups(landing: DataFrame, groups: DataFrame) -> DataFrame:
    """Messages of mapped topics with their group; other topics are ignored.

    The map was written by hand, which bounds its size.
    """
    return landing.join(F.broadcast(groups), "topic")


def group_results(landing: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group: messages loaded and how the load ended."""
    loaded = in_groups(landing, groups).groupBy("group_id").agg(F.count("*").alias("rows"))
    every = groups.select("group_id").distinct().join(loaded, "group_id", "left").na.fill(0, ["rows"])
    return every.withColumn("status", F.when(F.col("rows") > 0, F.lit("SUCCESS")).otherwise(F.lit("EMPTY")))


def cluster_names(clusters: DataFrame) -> DataFrame:
    """Table name and virtual topic per cluster of ``(cluster, topic)`` rows.

    The table is named by the first three path parts that hold a keyword, topics
    in order, else by the first two parts of the first topic. Only those few
    parts are kept per cluster.
    """
    first = clusters.groupBy("cluster").agg(F.min("topic").alias("first_topic"))
    numbered = number_rows(first, ["first_topic"], "cluster_no")
    parts = clusters.select("cluster", "topic", F.posexplode(F.split(F.lower("topic"), "/")).alias("pos", "part"))
    in_order = Window.partitionBy("cluster").orderBy("topic", "pos")
    core = (
        parts.where(F.col("part").rlike(TABLE_KEYWORDS))
        .withColumn("nth", F.row_number().over(in_order))
        .where(F.col("nth") <= NAME_PARTS)
        .groupBy("cluster")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "part"))).alias("core"))
    )
    named = numbered.join(core, "cluster", "left")
    plain = F.slice(F.split(F.btrim("first_topic", F.lit("/")), "/"), 1, 2)
    keywords = F.transform("core", lambda c: c["part"])
    return named.select(
        "cluster",
        "first_topic",
        (F.col("cluster_no") - 1).alias("cluster_no"),
        F.concat(F.lit("stg_"), F.lower(F.array_join(F.coalesce(keywords, plain), "_"))).alias("table_name"),
        F.concat(F.array_join(plain, "/"), F.lit("/virt_group_"), (F.col("cluster_no") - 1).cast("string")).alias(
            "virtual_topic"
        ),
    )

