"""Groups of topics by the similarity of their key sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstar.operators.numbering import number_rows
from sensorstar.session import broadcast_counted, pinned

# Keeps a rounding error from raising a bound that is a whole number.
_EPSILON = 1e-9


def jaccard(a, b):
    """Shared keys over all keys; 0 when a set is empty."""
    shared, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / every).otherwise(F.lit(0.0))


def distinct_sets(topics: DataFrame) -> DataFrame:
    """Every key set once, ``(set_id, keys)``: topics of one device type share it."""
    sets = topics.select("keys").distinct()
    return sets.select(F.sha2(F.array_join("keys", "\n"), 256).alias("set_id"), "keys")


def _postings(sets: DataFrame, threshold: float) -> DataFrame:
    """``(set_id, size, pos, key)``: the keys two similar sets must share one of.

    With keys ordered from rare to common, two similar sets share a key among the first
    ``n - ceil(t n) + 1`` of each.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    sized = sets.withColumn("size", F.size("keys"))
    keys = sized.select("set_id", "size", F.explode("keys").alias("key"))
    uses = keys.groupBy("key").agg(F.count("*").alias("uses"))
    ordered = (
        keys.join(broadcast_counted(uses), "key")
        .groupBy("set_id", "size")
        .agg(F.array_sort(F.collect_list(F.struct("uses", "key"))).alias("ranked"))
    )
    prefix = F.col("size") - F.ceil(F.col("size") * threshold - _EPSILON) + 1
    return ordered.select(
        "set_id", "size", F.posexplode(F.slice("ranked", F.lit(1), prefix.cast("int"))).alias("pos", "ranked")
    ).select("set_id", "size", "pos", F.col("ranked")["key"].alias("key"))


def _possible(threshold: float) -> Column:
    """Whether the sizes of two postings ``a`` and ``b`` of a key, and its places in them,
    still allow the similarity."""
    sizes = F.col("a.size") + F.col("b.size")
    needed = F.ceil(sizes * (threshold / (1 + threshold)) - _EPSILON)
    reachable = 1 + F.least(F.col("a.size") - F.col("a.pos"), F.col("b.size") - F.col("b.pos")) - 1
    near = F.least("a.size", "b.size") >= F.greatest("a.size", "b.size") * threshold - _EPSILON
    return near & (reachable >= needed)


def _verified(candidates: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` that are similar, with their keys."""
    with_a = candidates.join(sets.select(F.col("set_id").alias("a"), F.col("keys").alias("keys_a")), "a")
    both = with_a.join(sets.select(F.col("set_id").alias("b"), F.col("keys").alias("keys_b")), "b")
    scored = both.withColumn("similarity", jaccard("keys_a", "keys_b"))
    return scored.where(F.col("similarity") >= threshold - _EPSILON).select("a", "b", "keys_a", "keys_b", "similarity")


def similar_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """All pairs of sets with Jaccard similarity of at least ``threshold``.

    Exact, without comparing every pair: only the rarest keys are joined on, and within
    the join the sizes and the places of the shared key must still allow the similarity.
    """
    postings = _postings(sets, threshold)
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.set_id") < F.col("b.set_id"))
    found = postings.alias("a").join(postings.alias("b"), same & _possible(threshold))
    candidates = found.select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b")).distinct()
    return _verified(candidates, sets, threshold)


def _star_candidates(postings: DataFrame, threshold: float) -> DataFrame:
    """Each set of a key's list with one leader of the list."""
    leader = F.min(F.struct(F.xxhash64("set_id"), "set_id", "size", "pos")).alias("b")
    leaders = postings.groupBy("key").agg(leader)
    found = postings.alias("a").join(leaders.select("key", "b").alias("l"), "key")
    kept = found.where((F.col("a.set_id") != F.col("b.set_id")) & _possible(threshold))
    return kept.select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b")).distinct()


def _candidates_between(postings: DataFrame, components: DataFrame, threshold: float) -> DataFrame:
    """Pairs of sets of a key's list that are in different components. One of the two is
    outside the list's largest component, whose sets never meet each other."""
    labelled = postings.join(components, "set_id")
    counted = labelled.groupBy("key", "component").agg(F.count("*").alias("sets"))
    largest = counted.groupBy("key").agg(F.max(F.struct("sets", "component")).alias("_largest"), F.count("*").alias("_components"))
    several = pinned(labelled.join(largest.where("_components > 1"), "key").withColumn("largest", F.col("_largest.component")))
    outside = several.where("component != largest").alias("a")
    apart = (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component"))
    found = outside.join(several.alias("b"), apart & _possible(threshold))
    ids = F.col("a.set_id"), F.col("b.set_id")
    return found.select(F.least(*ids).alias("a"), F.greatest(*ids).alias("b")).distinct()


def chained_sets(sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(set_id, component)`` by chains of similar sets, and the links ``(a, b)`` that were
    looked at, without all similar pairs.

    First every list of sets with a key becomes a star around one of them, which joins
    most of a large cluster with one link a set. Only what the stars left in different
    components is compared within the lists then. Every similar pair is in one component
    or compared, so the components are exact.
    """
    postings = pinned(_postings(sets, threshold))
    links = pinned(_verified(_star_candidates(postings, threshold), sets, threshold).select("a", "b"))
    components = connected_sets(sets, links)
    between = pinned(_verified(_candidates_between(postings, components, threshold), sets, threshold).select("a", "b"))
    if between.isEmpty():
        return components, links
    label = components.select(F.col("set_id").alias("_id"), "component")
    ends = between.join(label, F.col("a") == F.col("_id")).select("b", F.col("component").alias("a"))
    ends = ends.join(label, F.col("b") == F.col("_id")).select("a", F.col("component").alias("b")).distinct()
    merged = connected_sets(components.select(F.col("component").alias("set_id")).distinct(), ends)
    merged = merged.select(F.col("set_id").alias("component"), F.col("component").alias("_whole"))
    whole = components.join(merged, "component").select("set_id", F.col("_whole").alias("component"))
    return whole, links.union(between)


def connected_sets(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(set_id, component)``: sets linked by any chain of similar pairs.

    Every set takes the smallest label among itself and its neighbours, then the
    label of that label, until nothing changes. Labels only fall, so it ends.
    """
    edges = pinned(
        pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = pinned(sets.select("set_id", F.col("set_id").alias("component")))
    while True:
        offered = (
            edges.join(labels, edges["b"] == labels["set_id"])
            .groupBy(F.col("a").alias("set_id"))
            .agg(F.min("component").alias("offered"))
        )
        nearer = labels.join(offered, "set_id", "left").select(
            "set_id", F.col("component").alias("before"), F.least("component", "offered").alias("near")
        )
        of_label = labels.select(F.col("set_id").alias("near"), F.col("component").alias("of_label"))
        moved = pinned(
            nearer.join(of_label, "near", "left").select(
                "set_id", "before", F.least("near", "of_label").alias("component")
            )
        )
        labels = moved.select("set_id", "component")
        if moved.where(F.col("component") != F.col("before")).isEmpty():
            return labels


def fuzzy_clusters(topics: DataFrame, threshold: float) -> DataFrame:
    """``(topic, cluster)`` by chains of similar key sets. The cluster id is the
    smallest set id in it."""
    sets = pinned(distinct_sets(topics))
    components, _ = chained_sets(sets, threshold)
    with_id = topics.withColumn("set_id", F.sha2(F.array_join("keys", "\n"), 256))
    return with_id.join(components, "set_id").select("topic", "keys", F.col("component").alias("cluster"))


def exact_groups(topics: DataFrame) -> DataFrame:
    """``(topic, keys, cluster)``: topics whose key sets are equal."""
    return topics.withColumn("cluster", F.sha2(F.array_join("keys", "\n"), 256))


def group_report(grouped: DataFrame) -> DataFrame:
    """Per group: topics and the union of their keys as sorted lists, largest
    group first. Topics and keys are metadata: one entry per topic, not per message."""
    keys = grouped.select("cluster", F.explode("keys").alias("key")).distinct()
    keys = keys.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_set("key")), ", ").alias("keys"))
    topics = grouped.groupBy("cluster").agg(
        F.count("*").alias("num_topics"),
        F.min("topic").alias("first_topic"),
        F.array_join(F.array_sort(F.collect_set("topic")), ", ").alias("topics"),
    )
    numbered = number_rows(topics.join(keys, "cluster"), ["first_topic"], "group_no")
    return numbered.select((F.col("group_no") - 1).alias("group_id"), "num_topics", "topics", "keys").orderBy(
        F.desc("num_topics"), "group_id"
    )
