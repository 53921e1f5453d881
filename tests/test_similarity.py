from __future__ import annotations

import random
from itertools import combinations

import pytest

from sensorstar.operators import grouping, similarity

KINDS = "topic string, keys array<string>"


def brute_pairs(sets, threshold):
    found = set()
    for a, b in combinations(sorted(set(map(frozenset, sets)), key=sorted), 2):
        if len(a & b) / len(a | b) >= threshold:
            found.add(frozenset((a, b)))
    return found


def brute_clusters(topics, threshold):
    parent = {t: t for t in topics}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a, b in combinations(topics, 2):
        if len(topics[a] & topics[b]) / len(topics[a] | topics[b]) >= threshold:
            parent[root(a)] = root(b)
    groups: dict[str, set[str]] = {}
    for t in topics:
        groups.setdefault(root(t), set()).add(t)
    return {frozenset(g) for g in groups.values()}


def random_topics(seed, n=120):
    rng = random.Random(seed)
    topics = {}
    for i in range(n):
        keys = {"common"} if rng.random() < 0.7 else set()
        keys |= {f"k{rng.randrange(25)}" for _ in range(rng.randint(1, 8))}
        topics[f"t{i:03d}"] = keys
    return topics


def frame(spark, topics):
    return spark.createDataFrame([(t, sorted(k)) for t, k in topics.items()], KINDS)


@pytest.mark.parametrize("threshold", [0.25, 0.5, 0.75, 1.0])
def test_pairs_match_brute_force(spark, threshold):
    topics = random_topics(int(threshold * 100))
    sets = similarity.distinct_sets(frame(spark, topics))
    found = similarity.similar_sets(sets, threshold).collect()
    pairs = {frozenset((frozenset(r["keys_a"]), frozenset(r["keys_b"]))) for r in found}
    assert pairs == brute_pairs(topics.values(), threshold) and len(pairs) == len(found)


def test_threshold_must_be_usable(spark):
    with pytest.raises(ValueError):
        similarity.similar_sets(similarity.distinct_sets(frame(spark, random_topics(1, 3))), 0)


@pytest.mark.parametrize("seed", [5, 6])
def test_clusters_match_brute_force(spark, seed):
    topics = random_topics(seed, 60)
    found: dict[str, set[str]] = {}
    for r in similarity.fuzzy_clusters(frame(spark, topics), 0.5).collect():
        found.setdefault(r["cluster"], set()).add(r["topic"])
    assert {frozenset(g) for g in found.values()} == brute_clusters(topics, 0.5)


def test_long_chain_is_one_cluster(spark):
    topics = {f"t{i:02d}": {f"k{i}", f"k{i + 1}", f"k{i + 2}"} for i in range(20)}
    found = similarity.fuzzy_clusters(frame(spark, topics), 0.5)
    assert found.select("cluster").distinct().count() == 1


@pytest.mark.parametrize("seed", [7, 8, 9])
def test_chains_need_few_links(spark, seed):
    """One large cluster, in which all sets are similar, and some small ones."""
    rng = random.Random(seed)
    topics = {f"t{i}": {f"c{k}" for k in range(9)} | {f"own{i}"} for i in range(150)}
    topics |= {f"u{i}": {f"d{rng.randrange(12)}" for _ in range(4)} for i in range(40)}
    topics |= {f"v{i}": {f"c{rng.randrange(9)}", f"own{i}", "d1"} for i in range(10)}
    sets = similarity.distinct_sets(frame(spark, topics))
    components, links = similarity.chained_sets(sets, 0.5)
    assert similarity.similar_sets(sets, 0.5).count() > 11_000 and links.count() < 3 * sets.count()
    found: dict[str, set[str]] = {}
    ids = sets.join(components, "set_id").collect()
    of_keys = {frozenset(r["keys"]): r["component"] for r in ids}
    for topic, keys in topics.items():
        found.setdefault(of_keys[frozenset(keys)], set()).add(topic)
    assert {frozenset(g) for g in found.values()} == brute_clusters(topics, 0.5)


def test_known_clusters(spark):
    topics = {"A": {"x", "y", "z"}, "B": {"x", "y"}, "C": {"y", "w"}, "D": {"q"}}
    found: dict[str, set[str]] = {}
    for r in similarity.fuzzy_clusters(frame(spark, topics), 0.5).collect():
        found.setdefault(r["cluster"], set()).add(r["topic"])
    assert {frozenset(g) for g in found.values()} == {frozenset("AB"), frozenset("C"), frozenset("D")}


def test_report_puts_large_groups_first(spark):
    topics = {"b": {"x"}, "a": {"x"}, "c": {"y", "z"}}
    rows = similarity.group_report(similarity.exact_groups(frame(spark, topics))).collect()
    assert [tuple(r) for r in rows] == [(0, 2, "a, b", "x"), (1, 1, "c", "y, z")]


def test_cluster_names(spark):
    rows = [("1", "/Energo/DCUK/x/1"), ("1", "/Energo/DCUK/y"), ("2", "/voda/KA-1/z"), ("2", "/water/KA")]
    found = grouping.cluster_names(spark.createDataFrame(rows, "cluster string, topic string")).orderBy("cluster").collect()
    assert [(r["table_name"], r["virtual_topic"]) for r in found] == [
        ("stg_energo_dcuk_energo", "Energo/DCUK/virt_group_0"),
        ("stg_voda_ka-1", "voda/KA-1/virt_group_1"),
    ]
