"""The queries on payloads of many shapes, and on measured latencies, by name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.functions import payload, text
from sensorstar.operators import discovery, flatten, grouping, latency, similarity
from sensorstar.plans.dynamic import DynamicStaging, stored_name
from sensorstar.plans.registered import Query, scratch
from sensorstar.session import literal, prepare
from sensorstar.sources import delimited, landing
from sensorstar.sources.sample_landing import sensor_landing, table

FUZZY = 0.5
BATCH = 1000
KNOWN_UNTIL = dt.datetime(1996, 1, 1)
LEVEL_TOPICS = "/voda/%"

# A map as an operator would write it; the last group has no messages.
GROUPS = {
    8: ["/Energo/DCUK/meter-0/act", "/Energo/DCUK/meter-0"],
    10: ["/Energo/DCUK/meter:0/har", "/Energo/DCUK/meter:1/har"],
    25: ["/voda/KA-1", "/voda/KA-2", "/ttndata/voda/eui.3"],
    26: ["/udp1881/0", "/udp1881/1", "/udp1881/2"],
    30: ["/cez/mve/decin/0", "/cez/mve/decin/1"],
    99: ["/silent/topic"],
}
FUSED = (8, 10)
# The dynamic load: ids of its first step, a group named last, and a width that some groups exceed.
FIRST_STEP = 700
LAST_GROUP = "status"
NARROW = 6

_staged: dict[tuple[str, str], DynamicStaging] = {}


def tolerant_payloads(spark, sf_dir):
    """What each message stands for: its kind and its keys."""
    value = payload.tolerant_payload(F.col("payload"))
    parsed = sensor_landing(spark, sf_dir).select("id", value.alias("value"))
    keys = F.array_join(F.map_keys(payload.as_object(F.col("value"))), ",")
    return parsed.select("id", payload.kind(F.col("value")).alias("kind"), keys.alias("keys"))


def decoded_bytes(spark, sf_dir):
    """Whole documents as bytes in three encodings, decoded without being told which. Some
    bytes before the text keep two of them from being read as another."""
    whole = F.col("text")
    encoded = (
        F.when(F.col("doc_id") % 3 == 0, F.encode(whole, "UTF-8"))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.unhex(F.lit("E89E20")), text.encode_central(whole)))
        .otherwise(F.concat(F.unhex(F.lit("81E820")), text.encode_latin(whole)))
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", text.decode_bytes(encoded).alias("decoded"))
    return documents.select("doc_id", F.md5("decoded").alias("digest"), F.length("decoded").alias("length"))


def repaired_text(spark, sf_dir):
    """Documents whose UTF-8 bytes were read as Latin-1, read right again."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    documents = table(spark, sf_dir, "documents")
    repaired = documents.select("doc_id", text.repair_utf8_read_as_latin1(broken).alias("repaired"))
    return repaired.select("doc_id", F.md5("repaired").alias("digest"))


def column_names(spark, sf_dir):
    """Column names made of page addresses and of whole documents."""
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    documents = table(spark, sf_dir, "documents").select(F.col("text").alias("path"))
    named = pages.union(documents).select(F.md5("path").alias("source"), text.column_name(F.col("path")).alias("name"))
    return named.select("source", F.md5("name").alias("digest"), F.length("name").alias("length")).distinct()


def _leaves(spark, sf_dir):
    rows = flatten.flattened(sensor_landing(spark, sf_dir))
    return flatten.leaf_rows(rows, "id", "time", "topic")


def _grouped_leaves(spark, sf_dir):
    """The same with the group of their message, found once a message."""
    rows = flatten.flattened(sensor_landing(spark, sf_dir))
    return flatten.leaf_rows(rows.withColumn("group", text.logical_topic(F.col("topic"), 1)), "id", "time", "topic", "group")


def flattened_leaves(spark, sf_dir):
    return _leaves(spark, sf_dir).select("id", "path", "text")


def list_elements(spark, sf_dir):
    rows = flatten.element_rows(sensor_landing(spark, sf_dir))
    return rows.select("id", "element", payload.kind(F.col("value")).alias("kind"))


def _element_leaves(spark, sf_dir, mode):
    rows = flatten.flattened_elements(sensor_landing(spark, sf_dir), mode)
    return flatten.leaf_rows(rows, "id", "element").select("id", "element", "path", "text")


def flattened_by_first_element(spark, sf_dir):
    return _element_leaves(spark, sf_dir, "first")


def flattened_lists_as_text(spark, sf_dir):
    return _element_leaves(spark, sf_dir, "text")


def column_catalogue(spark, sf_dir):
    return discovery.catalogue(_leaves(spark, sf_dir))


def column_catalogue_plain_text(spark, sf_dir):
    return discovery.catalogue(_leaves(spark, sf_dir), numeric_text=False).select("topic", "path", "type")


def shared_types(spark, sf_dir):
    """Whether the values of a path share a type or need a VARIANT column."""
    kinds = _grouped_leaves(spark, sf_dir)
    return discovery.safe_types(kinds, "group").select("group", "path", (F.col("type") == "VARIANT").alias("mixed"))


def added_columns(spark, sf_dir):
    """Columns that messages from 1996 on add to those known before."""
    leaves = _grouped_leaves(spark, sf_dir)
    known = discovery.catalogue(leaves.where(F.col("time") < literal(KNOWN_UNTIL)), "group")
    later = discovery.catalogue(leaves.where(F.col("time") >= literal(KNOWN_UNTIL)), "group")
    return discovery.evolved(known, later, "group").select("group", "path", "type", "first_seen_id")


def batch_columns(spark, sf_dir):
    leaves = _leaves(spark, sf_dir).withColumn("batch_no", F.floor((F.col("id") - 1) / BATCH))
    columns = discovery.batch_columns(leaves, "topic", "batch_no")
    return columns.withColumn("columns", F.array_join("columns", ","))


def wide_staging(spark, sf_dir):
    """The water-level group as one table, columns and types found in its messages."""
    rows = flatten.flattened(sensor_landing(spark, sf_dir).where(F.col("topic").like(LEVEL_TOPICS)))
    leaves = flatten.leaf_rows(rows.withColumn("group", F.lit("voda")), "id", "group")
    columns = discovery.column_types(discovery.catalogue(leaves, "group"))
    return discovery.wide(rows, ["id", "time", "topic"], columns)


def _conformed(spark, sf_dir):
    leaves = _grouped_leaves(spark, sf_dir)
    return discovery.conform_leaves(leaves, discovery.catalogue(leaves, "group"), "group")


def conformed_values(spark, sf_dir):
    return _conformed(spark, sf_dir).select("id", "path", "type", "whole", "number", "text", "rejected")


def rejected_values(spark, sf_dir):
    return _conformed(spark, sf_dir).where("rejected").select("id", "topic", "path", "type", "text")


def logical_topics(spark, sf_dir):
    rows = sensor_landing(spark, sf_dir).groupBy(text.logical_topic(F.col("topic")).alias("logical_topic"))
    return rows.agg(F.count("*").alias("messages"), F.count_distinct("topic").alias("topics"))


def topic_tables(spark, sf_dir):
    topics = landing.topic_catalogue(sensor_landing(spark, sf_dir))
    return topics.select("topic", text.topic_table(F.col("topic")).alias("table_name"))


def cluster_tables(spark, sf_dir):
    clusters = fuzzy_clusters(spark, sf_dir)
    return grouping.cluster_names(clusters.withColumnRenamed("first_topic", "cluster")).drop("cluster")


def topic_groups(spark, sf_dir):
    groups = grouping.manual_groups(spark, GROUPS, FUSED)
    rows = grouping.in_groups(sensor_landing(spark, sf_dir), groups)
    return rows.groupBy("group_id", "topic").agg(F.count("*").alias("messages"))


def group_results(spark, sf_dir):
    return grouping.group_results(sensor_landing(spark, sf_dir), grouping.manual_groups(spark, GROUPS, FUSED))


# ---- the dynamic load ---------------------------------------------------------------


def dynamic_staging(spark: SparkSession, sf_dir: str) -> DynamicStaging:
    """All groups, loaded in two steps."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        groups = grouping.manual_groups(spark, GROUPS, FUSED)
        tables = DynamicStaging(prepare(spark), scratch(spark, "dynamic"), groups).create()
        messages = sensor_landing(spark, sf_dir)
        tables.load(messages, up_to_id=FIRST_STEP)
        tables.load(messages)
        _staged[key] = tables
    return _staged[key]


def dynamic_rows(spark, sf_dir):
    """Every cell of every table: whole numbers, other numbers and other values apart."""
    tables, found = dynamic_staging(spark, sf_dir), None
    for group in tables.names:
        rows, kinds = tables.table(group), tables.columns(group)
        cells = []
        for path, kind in sorted(kinds.items()):
            value, whole, number = F.col(stored_name(path)), kind == "BIGINT", kind == "DOUBLE PRECISION"
            shown = F.date_format(value, "yyyy-MM-dd HH:mm:ss") if kind == "TIMESTAMPTZ" else value.cast("string")
            cells.append(
                F.struct(
                    F.lit(path).alias("path"),
                    (value if whole else F.lit(None)).cast("long").alias("whole"),
                    (value if number else F.lit(None)).cast("double").alias("number"),
                    (F.lit(None) if whole or number else shown).cast("string").alias("text"),
                )
            )
        if cells:
            one = rows.select(F.lit(group).alias("group_id"), "landing_id", "topic", F.inline(F.array(*cells)))
            found = one if found is None else found.unionByName(one)
    return found


def dynamic_columns(spark, sf_dir):
    return dynamic_staging(spark, sf_dir).catalogue()


def dynamic_rejects(spark, sf_dir):
    """Values that did not fit their column, read back from the stored rows."""
    tables, found = dynamic_staging(spark, sf_dir), None
    for group in tables.names:
        one = tables.rejects(group).withColumn("group_id", F.lit(group))
        found = one if found is None else found.unionByName(one)
    return found


def dynamic_results(spark, sf_dir):
    """How a load of narrow tables ends for each group: loaded, silent, too wide, or not
    reached before the load was stopped."""
    groups = grouping.manual_groups(spark, {**GROUPS, LAST_GROUP: ["status"]}, FUSED)
    tables = DynamicStaging(prepare(spark), scratch(spark, "dynamic"), groups, widest=NARROW).create()
    asked = iter(range(len(tables.names)))
    tables.load(sensor_landing(spark, sf_dir), stop=lambda: next(asked) == len(tables.names) - 1)
    events = tables.run_events()
    return events.select("job_name", F.col("topic").alias("group_id"), "status", F.col("rows_inserted").alias("rows"), "error_message")


def _latest(spark, sf_dir):
    return landing.latest_payloads(sensor_landing(spark, sf_dir))


def structure_signatures(spark, sf_dir):
    structures = flatten.topic_structures(_latest(spark, sf_dir))
    return structures.withColumn("keys", F.array_join("keys", ", "))


def structure_report(spark, sf_dir):
    structures = flatten.topic_structures(_latest(spark, sf_dir))
    return similarity.group_report(similarity.exact_groups(structures))


def structure_report_file(spark, sf_dir):
    path = scratch(spark, "report")
    delimited.write_group_report(structure_report(spark, sf_dir), path)
    return spark.read.option("sep", ";").option("header", True).schema(
        "GroupID long, NumTopics long, Topics string, Keys string"
    ).csv(path)


def similar_key_sets(spark, sf_dir):
    sets = similarity.distinct_sets(flatten.topic_columns(_latest(spark, sf_dir)))
    pairs = similarity.similar_sets(sets, 0.25)
    a, b = F.array_join("keys_a", ", "), F.array_join("keys_b", ", ")
    return pairs.select(
        F.least(a, b).alias("keys_a"), F.greatest(a, b).alias("keys_b"), F.round("similarity", 6).alias("similarity")
    )


def fuzzy_clusters(spark, sf_dir):
    """Each topic with the first topic of its cluster."""
    found = similarity.fuzzy_clusters(flatten.topic_columns(_latest(spark, sf_dir)), FUZZY)
    first = found.groupBy("cluster").agg(F.min("topic").alias("first_topic"))
    return found.join(first, "cluster").select("topic", "first_topic")


# ---- latencies ------------------------------------------------------------------------


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as benchmark calls: the type is the database, the user gives
    the number of concurrent users, the value is the latency."""
    users = F.element_at(F.array(F.lit(1), F.lit(5), F.lit(10), F.lit(20)), (F.col("user_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("database"),
        users.alias("concurrency"),
        F.col("value").alias("latency"),
        (F.col("event_id") % 1000 * 60).cast("double").alias("started"),
        (F.col("event_id") % 1000 * 60 + F.col("value")).alias("ended"),
    )


def latency_summary(spark, sf_dir):
    return latency.latency_summary(latencies(spark, sf_dir))


def throughput(spark, sf_dir):
    return latency.throughput(latencies(spark, sf_dir))


def refreshed_results(spark, sf_dir):
    """Stored throughput, with two databases tested again on slower answers."""
    stored = latency.throughput(latencies(spark, sf_dir))
    again = latencies(spark, sf_dir).where(F.col("database").isin("click", "view"))
    slower = again.withColumn("ended", F.col("ended") + 100_000)
    return latency.refreshed(stored, latency.throughput(slower))


def throughput_pivot(spark, sf_dir):
    databases = ["click", "error", "purchase", "signup", "view"]
    return latency.tps_pivot(latency.throughput(latencies(spark, sf_dir)), databases)


def sensor_queries() -> dict[str, Query]:
    plain = [
        tolerant_payloads, decoded_bytes, repaired_text, column_names, flattened_leaves, list_elements,
        flattened_by_first_element, flattened_lists_as_text, column_catalogue, column_catalogue_plain_text,
        shared_types, added_columns, batch_columns, wide_staging, conformed_values, rejected_values, logical_topics,
        topic_tables, cluster_tables, topic_groups, group_results, structure_signatures, structure_report,
        structure_report_file, similar_key_sets, fuzzy_clusters, latency_summary, throughput, refreshed_results,
        throughput_pivot, dynamic_rows, dynamic_columns, dynamic_rejects, dynamic_results,
    ]
    return {query.__name__: query for query in plain}
