from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorstar.operators import control, dimensions, facts
from sensorstar.plans import semantic
from sensorstar.plans.profiles import PROFILES
from sensorstar.plans.registered import ALL_TOPICS, loaded_warehouse, scratch
from sensorstar.plans.semantic import Filter
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import literal_rows
from sensorstar.sources import delimited
from sensorstar.sources.sample_landing import camera_landing
from sensorstar.streaming.incremental import stream_load

LABELS = ["id", "velocity", "city_name", "country_code", "sensor_code", "vehicle_class", "license_plate", "detection_type"]


def labelled(warehouse):
    return sorted(map(repr, semantic.camera_cube(warehouse).details(LABELS).collect()))


def new_warehouse(spark, name):
    return Warehouse(spark, scratch(spark, name), start=dt.date(2024, 1, 1), end=dt.date(2024, 3, 1)).create()


@pytest.fixture(scope="module")
def whole(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir)


def test_rows_are_kept(whole, spark, sf_dir):
    assert whole.facts().count() == whole.staging().count() == camera_landing(spark, sf_dir).count()


def test_two_steps_equal_one(whole, spark, sf_dir):
    warehouse = new_warehouse(spark, "steps")
    messages = camera_landing(spark, sf_dir)
    first = warehouse.load(messages, ALL_TOPICS, up_to_id=400)
    second = warehouse.load(messages, ALL_TOPICS)
    again = warehouse.load(messages, ALL_TOPICS)
    assert (first.staged, again.staged, again.new_members) == (400, 0, 0)
    assert warehouse.loads() == 2
    assert first.staged + second.staged == messages.count()
    assert labelled(warehouse) == labelled(whole)
    members = warehouse.members()
    assert facts.duplicate_members(members).isEmpty()
    assert members.groupBy("dimension", "key").count().where("count > 1").isEmpty()
    highest = members.groupBy("dimension").agg(F.max("key").alias("k"), F.count("*").alias("n"))
    assert highest.where("k <> n - 1").isEmpty()


def test_failed_load_stays_invisible_and_can_be_repeated(whole, spark, sf_dir, monkeypatch):
    warehouse = new_warehouse(spark, "failing")
    messages = camera_landing(spark, sf_dir)
    lookup = facts.star_lookup

    def broken(*args):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(facts, "star_lookup", broken)
    with pytest.raises(RuntimeError):
        warehouse.load(messages, ALL_TOPICS)
    assert warehouse.facts().count() == 0 and warehouse.staging().count() == 0
    assert warehouse.members().count() == len(dimensions.NATURAL_KEYS)
    runs = control.runs(warehouse.run_events()).collect()
    assert [(r["status"], r["error_message"]) for r in runs] == [("ERROR", "executor lost")]
    monkeypatch.setattr(facts, "star_lookup", lookup)
    warehouse.load(messages, ALL_TOPICS)
    assert labelled(warehouse) == labelled(whole)


def test_stream_equals_batch(whole, spark, sf_dir):
    root = scratch(spark, "stream")
    messages = camera_landing(spark, sf_dir)
    messages.where("id <= 500").coalesce(1).write.parquet(f"{root}/landing")
    warehouse = new_warehouse(spark, "streamed")
    stream_load(spark, f"{root}/landing", warehouse, ALL_TOPICS, f"{root}/checkpoint")
    messages.where("id > 500").coalesce(1).write.mode("append").parquet(f"{root}/landing")
    stream_load(spark, f"{root}/landing", warehouse, ALL_TOPICS, f"{root}/checkpoint")
    assert warehouse.loads() == 2
    assert labelled(warehouse) == labelled(whole)
    assert warehouse.load_messages(messages, ALL_TOPICS, 0).loaded == 0


def test_reset_keeps_only_unknown_members(spark, sf_dir):
    warehouse = new_warehouse(spark, "reset")
    warehouse.load(camera_landing(spark, sf_dir).where("id < 50"), ALL_TOPICS)
    warehouse.reset()
    assert warehouse.facts().count() == 0
    assert {(r["member"], r["key"]) for r in warehouse.members().collect()} == {("UNKNOWN", -1)}
    assert warehouse.load(camera_landing(spark, sf_dir).where("id < 50"), ALL_TOPICS).staged == 49


@pytest.mark.parametrize("name", sorted(PROFILES))
def test_profiles_seed_their_unknown_members(spark, name):
    profile = PROFILES[name]
    rows = {r["dimension"]: r for r in dimensions.unknown_members(spark, profile).collect()}
    assert {r["key"] for r in rows.values()} == {profile.unknown_key}
    assert rows["country"]["member"] == profile.unknown_country and rows["city"]["member"] == profile.unknown_label


def test_unknown_row_is_added_once(spark):
    known = literal_rows(spark, "key long, member string", [(1, "a")])
    unknown = literal_rows(spark, "key long, member string", [(-1, "UNKNOWN")])
    once = dimensions.with_unknown(known, unknown, "key")
    assert dimensions.with_unknown(once, unknown, "key").count() == 2


def test_hot_plates_are_split(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("landing_id"),
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("P"), F.col("id") % 50)).alias("lp"),
    )
    members = rows.where("lp is not null").select(F.col("lp").alias("member")).distinct()
    members = members.withColumn("key", F.xxhash64("member"))
    counts = rows.where("lp is not null").groupBy(F.lit("plate").alias("dimension"), F.col("lp").alias("member")).agg(F.count("*").alias("uses"))
    hot = facts.hot_members(counts, "plate", hot_rows=1000)
    assert [r["member"] for r in hot.collect()] == ["HOT"]
    found = facts.salted_lookup(rows, members, hot, F.col("lp"), "lp_key", "landing_id")
    assert found.count() == 6000
    wrong = found.where(~(F.col("lp_key").eqNullSafe(F.when(F.col("lp").isNotNull(), F.xxhash64("lp")))))
    assert wrong.isEmpty()


def test_marks(spark):
    kind = "topic string, process_step int, last_loaded_id long, full_load_done boolean, last_update timestamp"
    day = [dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 2)]
    old = literal_rows(spark, kind, [("t", 1, 10, True, day[0])])
    new = literal_rows(spark, kind, [("t", 1, 7, True, day[1]), ("u", 1, 3, True, day[1])])
    guarded = {r["topic"]: r["last_loaded_id"] for r in control.guarded_upsert(old, new).collect()}
    plain = {r["topic"]: r["last_loaded_id"] for r in control.plain_upsert(old, new).collect()}
    assert guarded == {"t": 10, "u": 3} and plain == {"t": 7, "u": 3}
    assert control.high_water_mark(old, "none").first()[0] == 0


def test_nothing_to_resume(spark):
    empty = literal_rows(spark, "landing_id long", [])
    assert control.resume_range(empty, 0, 10).first()["has_rows"] is False


def test_handoff_keeps_blank_and_missing_apart(spark):
    path = scratch(spark, "handoff-test")
    rows = [(1, ""), (2, None), (3, "a,b"), (4, 'q"q'), (5, " x ")]
    delimited.write_handoff(spark.createDataFrame(rows, "n int, t string"), path)
    found = delimited.read_handoff(spark, path, "n int, t string").collect()
    assert sorted(map(tuple, found)) == rows


# ---- plans ------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_skips_weeks(whole):
    cube = semantic.camera_cube(whole)
    window = semantic.between(dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 12))
    text = plan(cube.query(["detections"], ["city_name"], window))
    assert "week_bucket" in text.split("PartitionFilters")[1]
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_large_calendars_are_not_broadcast(whole):
    cube = semantic.camera_cube(whole)
    assert "BroadcastHashJoin" in plan(cube.details(["id", "hour"]))
    cube.known_rows = {"calendar": 10**9}
    limit = whole.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    whole.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1kb")
    try:
        assert "SortMergeJoin" in plan(cube.details(["id", "hour"]))
    finally:
        whole.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_only_named_dimensions_are_joined(whole):
    text = plan(semantic.camera_cube(whole).query(["avg_velocity"], ["vehicle_class"], how="inner"))
    assert text.count("FileScan") == 2
    assert "ReadSchema: struct<vehicle_class_key:bigint,velocity:double>" in text


def test_scan_reads_two_columns_and_pushes_the_mark(spark, sf_dir):
    from sensorstar.sources.landing import incremental_scan, read_landing

    path = scratch(spark, "landing")
    camera_landing(spark, sf_dir).write.parquet(path)
    text = plan(incremental_scan(read_landing(spark, path), "/Bilina/%", 17).select("id"))
    assert "GreaterThan(id,17)" in text and "StringStartsWith(topic,/Bilina/)" in text
    assert "ReadSchema: struct<id:bigint,topic:string>" in text


def test_staging_needs_no_shuffle(spark, sf_dir):
    from sensorstar.operators.staging import camera_staging

    assert "Exchange" not in plan(camera_staging(camera_landing(spark, sf_dir)))


def test_hidden_members_cannot_be_shown(whole):
    cube = semantic.camera_cube(whole)
    assert "lp_key_hidden" not in cube.visible()
    with pytest.raises(ValueError):
        cube.view({"facts": ["lp_key_hidden"]})


def test_distinct_counts_are_not_stored(whole, spark):
    with pytest.raises(ValueError):
        semantic.camera_cube(whole).build_rollup(["unique_plates"], ["city_name"], scratch(spark, "bad"))


def test_filters(whole):
    cube = semantic.camera_cube(whole)
    total = cube.query(["detections"]).first()[0]
    split = [
        cube.query(["detections"], filters=[Filter("velocity", op, 50)]).first()[0] for op in ("lte", "gt")
    ] + [cube.query(["detections"], filters=[Filter("velocity", "not_set")]).first()[0]]
    assert sum(split) == total


def test_fact_files_are_sorted_by_time_and_sensor(whole, spark):
    rows = spark.read.parquet(whole.path("facts")).select(F.input_file_name().alias("file"), "time_key", "sensor_key")
    order = {}
    for r in rows.collect():
        order.setdefault(r["file"], []).append((r["time_key"], r["sensor_key"]))
    assert len(order) >= 5 and all(keys == sorted(keys) for keys in order.values())


def test_dump_import(spark):
    from sensorstar.sources.landing import import_dump

    path = scratch(spark, "dump")
    lines = ["id,created,amount", "1,2024-01-02 03:04:05,1.255", "2,0000-00-00 00:00:00,n/a", "3,\\N,7"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    rows = import_dump(spark, path, "id long, created string, amount string", ["created"], ["amount"])
    found = [(r["id"], str(r["created"]), str(r["amount"])) for r in rows.orderBy("id").collect()]
    assert found == [(1, "2024-01-02 03:04:05", "1.26"), (2, "None", "None"), (3, "None", "7.00")]


def test_results_do_not_depend_on_the_session_zone(whole, spark):
    window = semantic.between(dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 12, 12))

    def asked():
        warehouse = Warehouse(spark, whole.root)
        found = semantic.camera_cube(warehouse).query(["detections"], ["full_date", "weekday"], window, grain="hour")
        first = dimensions.calendar(spark, dt.date(2024, 3, 31), dt.date(2024, 4, 1))
        return sorted(map(tuple, found.collect())), first.agg(F.min("full_date"), F.max("hour_num"), F.count("*")).first()

    before = spark.conf.get("spark.sql.session.timeZone")
    wanted = asked()
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert asked() == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
