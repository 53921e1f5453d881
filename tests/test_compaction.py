"""Compaction over many loads: few files, same answers, readers undisturbed, dead runs repeated."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorstar.plans.segments import MERGE_RATIO, SegmentStore, kept_and_merged
from sensorstar.plans.semantic import Filter, camera_cube
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import literal_rows

START = dt.datetime(2024, 1, 1)
MEMBERS = ["id", "velocity", "license_plate", "sensor_code", "full_date"]


def landing(spark, count, days=1.5):
    rows = []
    for n in range(1, count + 1):
        at = None if n % 17 == 0 else START + dt.timedelta(days=days * n % 30)
        rows.append((n, at, f"/Bilina/kamery/camea/{n % 3}", '{"lp":"P%d","sensor":"S%d","velocity":%d}' % (n % 11 + n // 20, n % 4, n % 90)))
    return literal_rows(spark, "id long, time timestamp_ntz, topic string, payload string", rows)


def loaded(spark, path, messages, loads, each, compact=()):
    warehouse = Warehouse(spark, str(path), end=dt.date(2024, 2, 1)).create()
    for load in range(1, loads + 1):
        warehouse.load(messages, "%", up_to_id=load * each)
        if load in compact:
            warehouse.compact()
    return warehouse


def answers(warehouse):
    return Counter(map(tuple, camera_cube(warehouse).details(MEMBERS).collect()))


def files(path, table):
    return [p for p in path.glob(f"{table}*/**/*.parquet") if p.stat().st_size]


def test_same_answers_few_files(spark, tmp_path):
    messages = landing(spark, 120)
    plain = loaded(spark, tmp_path / "plain", messages, 8, 15)
    warehouse = loaded(spark, tmp_path / "compact", messages, 8, 15, compact=(3, 4, 6, 8))
    assert answers(warehouse) == answers(plain) and sum(answers(plain).values()) == 120
    assert Counter(map(tuple, warehouse.members().select("dimension", "member", "key").collect())) == Counter(
        map(tuple, plain.members().select("dimension", "member", "key").collect())
    )
    columns = sorted(set(plain.staging().columns) - {"load_dttm"})
    assert Counter(map(tuple, warehouse.staging().select(columns).collect())) == Counter(map(tuple, plain.staging().select(columns).collect()))
    # Earlier states are still answered, and a later load goes on with the same keys.
    assert warehouse.facts(5).count() == 75 and warehouse.facts(8, 5).count() == 45
    assert warehouse.vacuum() > 0
    assert answers(warehouse) == answers(plain) and answers(Warehouse(spark, warehouse.root, end=dt.date(2024, 2, 1))) == answers(plain)
    for table, few in (("facts", 40), ("members", 20), ("staging", 8)):
        assert len(files(tmp_path / "compact", table)) < few
    more = landing(spark, 130)
    assert warehouse.load(more, "%").loaded == plain.load(more, "%").loaded == 10
    assert answers(warehouse) == answers(plain)


def test_readers_are_not_disturbed(spark, tmp_path):
    messages = landing(spark, 60)
    warehouse = loaded(spark, tmp_path, messages, 3, 20)
    before, expected = warehouse.facts(), answers(warehouse)
    reader = Warehouse(spark, warehouse.root, end=dt.date(2024, 2, 1))
    assert reader.facts().count() == 60
    warehouse.compact()
    assert before.count() == 60 and reader.facts().count() == 60 and answers(warehouse) == expected
    warehouse.load(landing(spark, 80), "%")
    warehouse.compact()
    warehouse.vacuum(keep=1)
    # What the compaction before the last named is still there.
    older = warehouse._store.manifest(warehouse._tables()["facts"], 1, -1)
    assert warehouse._store.read(warehouse._tables()["facts"], older).count() == 60


def test_a_compaction_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    messages = landing(spark, 60)
    warehouse = loaded(spark, tmp_path, messages, 3, 20)
    expected, compact = answers(warehouse), SegmentStore.compact

    def dying(self, table, *rest):
        found = compact(self, table, *rest)
        if table.name == "members":
            raise RuntimeError("driver lost")
        return found

    monkeypatch.setattr(SegmentStore, "compact", dying)
    with pytest.raises(RuntimeError, match="driver lost"):
        warehouse.compact()
    assert answers(warehouse) == expected
    monkeypatch.setattr(SegmentStore, "compact", compact)
    merged = warehouse.compact()
    assert merged["facts"] == merged["staging"] == 60 and answers(warehouse) == expected
    assert warehouse.compact() == {}
    warehouse.reset()
    assert warehouse.facts().count() == 0 and warehouse.load(messages, "%").loaded == 60


def test_segments_are_sorted_over_a_week(spark, tmp_path):
    """Files of a week hold times of their own, so a filter on times reads few of them."""
    warehouse = loaded(spark, tmp_path, landing(spark, 90, days=0.07), 3, 30)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        warehouse.compact()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    named = warehouse.facts().withColumn("file", F.input_file_name()).where("time_key > 0")
    spans = named.groupBy("week_bucket", "file").agg(F.min("time_key").alias("low"), F.max("time_key").alias("high")).collect()
    for one in spans:
        for other in spans:
            assert one["file"] == other["file"] or one["week_bucket"] != other["week_bucket"] or one["high"] <= other["low"] or other["high"] <= one["low"]
    assert max(Counter(s["week_bucket"] for s in spans).values()) > 1


def test_which_segments_are_merged():
    assert kept_and_merged([(1, 1000), (2, 100), (3, 10)], 10) == ([(1, 1000), (2, 100)], [3])
    assert kept_and_merged([(1, 1000), (2, 100), (3, 10)], 30) == ([(1, 1000)], [3, 2])
    assert kept_and_merged([], 5) == ([], [])
    # A part gets a logarithmic number of segments, and a row is rewritten as rarely.
    segments, written = [], 0
    for number in range(1, 1001):
        kept, merged = kept_and_merged(segments, 1)
        rows = 1 + sum(r for n, r in segments if n in merged)
        segments, written = [*kept, (number, rows)], written + rows
    assert len(segments) <= 6 and sum(r for _, r in segments) == 1000 and written < 1000 * MERGE_RATIO * 5


def test_filters_reach_the_segments(spark, tmp_path):
    warehouse = loaded(spark, tmp_path, landing(spark, 60), 2, 30, compact=(2,))
    found = camera_cube(warehouse).query(["detections"], ["city_name"], [Filter("week_bucket", "equals", dt.date(2024, 1, 8))])
    assert "PartitionFilters: [isnotnull(week_bucket" in found._jdf.queryExecution().executedPlan().toString()
    everything = warehouse.facts().where(F.col("week_bucket") == dt.date(2024, 1, 8)).count()
    assert sum(r["detections"] for r in found.collect()) == everything > 0
