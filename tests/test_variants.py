"""Loads by the rules of the variants, and lookups with heavy members."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorstar.operators import dimensions, facts, staging
from sensorstar.plans.profiles import CANON, CLICKHOUSE, MARIADB, MSSQL, POSTGRES, PROFILES
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import literal_rows

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 3)


def message(**fields):
    shown = ", ".join(f'"{name}": {value}' for name, value in fields.items())
    return "{" + shown + "}"


def loaded(spark, tmp_path, profile, payloads, times=None):
    times = times or [dt.datetime(2024, 1, 1, 10, 30, 5)] * len(payloads)
    rows = [(n, at, "/Bilina/kamery/camea/1", payload) for n, (at, payload) in enumerate(zip(times, payloads, strict=True), 1)]
    landing = literal_rows(spark, "id long, time timestamp_ntz, topic string, payload string", rows)
    warehouse = Warehouse(spark, str(tmp_path / profile.name), profile, START, END).create()
    return warehouse, warehouse.load(landing, "%")


@pytest.mark.parametrize("profile", PROFILES.values(), ids=PROFILES)
def test_missing_velocity(spark, tmp_path, profile):
    warehouse, report = loaded(spark, tmp_path, profile, [message(velocity=50), message(lp='"A"'), message(velocity='"x"')])
    velocities = [r["velocity"] for r in warehouse.facts().orderBy("camera_detection_key").collect()]
    rejected = [r["landing_id"] for r in warehouse.rejected().collect()]
    assert (report.staged, report.loaded, report.rejected) == (3, len(velocities), len(rejected))
    expected = {"kept": ([50, None, None], []), "zero": ([50, 0, 0], []), "required": ([50], [2, 3])}
    assert (velocities, sorted(rejected)) == expected[profile.velocity]


def test_blank_members(spark, tmp_path):
    payloads = [message(sensor=f'"{text}"', velocity=1) for text in ("S1", " S1 ", "", "  ")]
    trimmed, _ = loaded(spark, tmp_path, CANON, payloads)
    assert [r["sensor_key"] for r in trimmed.facts().orderBy("camera_detection_key").collect()] == [1, 1, -1, -1]
    as_is, _ = loaded(spark, tmp_path, CLICKHOUSE, payloads)
    names = {r["member"]: r["key"] for r in as_is.members_of("sensor").collect()}
    assert set(names) == {"UNKNOWN", "S1", " S1 ", "  "}
    keys = [r["sensor_key"] for r in as_is.facts().orderBy("camera_detection_key").collect()]
    assert keys == [names["S1"], names[" S1 "], 4294967295, 4294967295]


@pytest.mark.parametrize(("profile", "keys", "rows"), [
    (CANON, [1104071, 1104071 + 2879, -1], 2881),
    (MARIADB, [1104071, 1104071 + 2879, -1], 2881),
    (MSSQL, [1, -1, -1], 1441),
    (POSTGRES, [1, 2880, -1], 2881),
    (CLICKHOUSE, [1704067200, 1704239999, 1704240000], 2880),
], ids=lambda x: getattr(x, "name", ""))
def test_time_keys_and_calendars(spark, tmp_path, profile, keys, rows):
    times = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 23, 59, 59), dt.datetime(2024, 1, 3)]
    warehouse, _ = loaded(spark, tmp_path, profile, [message(velocity=1)] * 3, times)
    assert [r["time_key"] for r in warehouse.facts().orderBy("camera_detection_key").collect()] == keys
    calendar = {r["time_key"]: r for r in warehouse.calendar().collect()}
    assert len(calendar) == rows and rows <= warehouse.calendar_rows()
    monday = calendar[keys[0]]
    assert monday["day_of_week_num"] == (2 if profile.weekdays == "sunday" else 1)
    if profile.unknown_time:
        assert tuple(calendar[-1])[1:] == profile.unknown_time
    else:
        assert -1 not in calendar
    if profile.full_date == "day":
        assert calendar[2880]["full_date"] == dt.datetime(2024, 1, 2)


def heavy(spark, count=20_000):
    """Staging rows of which nine in ten have one plate, and a tenth of the rest none."""
    fields = [f.split()[0] for f in staging.STAGING_SCHEMA.split(", ")]
    plate = F.when(F.col("id") % 10 != 0, "HOT").when(F.col("id") % 100 != 0, F.concat(F.lit("P"), F.col("id").cast("string")))
    rows = spark.range(1, count + 1).select(F.col("id").alias("landing_id"), plate.alias("lp"), (F.col("id") % 7).cast("string").alias("sensor"))
    rows = rows.withColumn("original_time", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("velocity", F.lit(1))
    missing = [F.lit(None).cast("string").alias(f) for f in fields if f not in rows.columns]
    return rows.select("*", *missing)


def test_heavy_members_are_cut_by_their_measured_share(spark):
    rows = heavy(spark)
    counts = dimensions.member_counts(rows)
    hot = facts.hot_members(counts, hot_rows=1000, task_rows=1000)
    assert {(r["dimension"], r["member"]): r["salts"] for r in hot.collect()} == {
        ("plate", "HOT"): 18, **{("sensor", str(n)): 3 for n in range(7)},
    }
    members = counts.where("dimension = 'plate'").select("member", F.xxhash64("member").alias("key"))
    found = facts.salted_lookup(rows, members, hot.where("dimension = 'plate'"), F.col("lp"), "lp_key", "landing_id")
    assert "_salt" in found._jdf.queryExecution().optimizedPlan().toString()
    wrong = found.where(~F.col("lp_key").eqNullSafe(F.when(F.col("lp").isNotNull(), F.xxhash64("lp"))))
    assert found.count() == 20_000 and wrong.count() == 0


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_no_task_gets_the_heavy_member(spark, broadcast):
    """With the join shuffled, no task reads much more than its share."""
    rows = heavy(spark).cache()
    counts = dimensions.member_counts(rows)
    members = counts.where("dimension = 'plate'").select("member", F.xxhash64("member").alias("key"))
    hot = facts.hot_members(counts, "plate", hot_rows=1000, task_rows=500)
    conf = {"spark.sql.autoBroadcastJoinThreshold": broadcast, "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        found = facts.salted_lookup(rows, members, hot, F.col("lp"), "lp_key", "landing_id")
        largest = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        rows.unpersist()
    assert largest < 20_000 / 16 * 3 if broadcast == "-1" else largest <= 20_000


def test_splitting_changes_no_fact(spark):
    rows = heavy(spark, 3000)
    counts = dimensions.member_counts(rows)
    keyed = dimensions.dense_keys(counts.drop("uses")).cache()
    members = {d: keyed.where(F.col("dimension") == d).select("member", "key") for d in dimensions.NATURAL_KEYS}
    hot = facts.hot_members(counts, hot_rows=10, task_rows=50)
    split = facts.star_lookup(rows, members, hot, CANON, split=list(dimensions.NATURAL_KEYS))
    whole = facts.star_lookup(rows, members, hot, CANON, split=[])
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, whole.collect()))


def test_only_large_dimensions_are_split(spark, tmp_path, monkeypatch):
    warehouse, _ = loaded(spark, tmp_path, CANON, [message(velocity=1, lp='"A"', sensor='"S"')])
    hot_members = facts.hot_members
    monkeypatch.setattr(facts, "hot_members", lambda counts: hot_members(counts, hot_rows=100))
    counts = dimensions.member_counts(heavy(spark, 3000))
    keyed = dimensions.dense_keys(counts.drop("uses"))
    monkeypatch.setattr(facts, "SMALL_DIMENSION", 100)
    assert warehouse._hot_members(counts, keyed)[1] == ["plate"]
    monkeypatch.setattr(facts, "SMALL_DIMENSION", 1000)
    assert warehouse._hot_members(counts, keyed)[1] == []
