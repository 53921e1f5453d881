"""The queries of the camera pipeline, by name.

Each takes a session and a folder of tables. Queries about the star run on a
warehouse that is loaded once per session and folder, as its users would.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.functions import numbers, text, timeparts
from sensorstar.operators import control, dimensions, facts, staging
from sensorstar.plans import analytics, semantic
from sensorstar.plans.profiles import CANON, CLICKHOUSE, PROFILES, Profile
from sensorstar.plans.rollups import Rollup, RollupStore
from sensorstar.plans.semantic import Filter
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import literal, pinned, prepare, shared_folder
from sensorstar.sources import delimited, landing
from sensorstar.sources.sample_landing import camera_landing, table
from sensorstar.streaming.incremental import stream_load

Query = Callable[[SparkSession, str], DataFrame]

CAMERA_PATTERN = "/Bilina/kamery/camea/%"
ALL_TOPICS = "%"
FIRST_DAY_END = dt.datetime(2024, 1, 2)
BATCH = 500
PROFILE_END = dt.date(2024, 1, 21)
LOAD_STEPS = 3
ROLLUP_MEASURES = ("avg_velocity", "detections", "max_velocity", "min_velocity")
ROLLUPS = (
    Rollup("cities", ROLLUP_MEASURES, ("city_name", "country_code")),
    Rollup("days", ROLLUP_MEASURES, ("city_name", "country_code", "month", "day")),
    Rollup("sensors", ROLLUP_MEASURES, ("city_name", "country_code", "sensor_code", "vehicle_class", "full_date", "month", "day")),
)

_warehouses: dict[tuple[str, ...], Warehouse] = {}
_stepwise: dict[tuple[str, str], tuple[Warehouse, RollupStore]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one run, on storage all executors share."""
    return f"{shared_folder(spark)}/sensorstar/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        warehouse = Warehouse(prepare(spark), scratch(spark, "warehouse")).create()
        warehouse.load(camera_landing(spark, sf_dir), ALL_TOPICS)
        _warehouses[key] = warehouse
    return _warehouses[key]


def cube(spark: SparkSession, sf_dir: str) -> semantic.Cube:
    return semantic.camera_cube(loaded_warehouse(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.camera_staging(camera_landing(spark, sf_dir))


# ---- landing ------------------------------------------------------------------------


def incremental_scan(spark, sf_dir):
    return landing.incremental_scan(camera_landing(spark, sf_dir), CAMERA_PATTERN, 100)


def topic_scan(spark, sf_dir):
    return landing.topic_scan(camera_landing(spark, sf_dir), ["/Decin/kamery/camea/0", "/Usti/kamery/camea/1"])


def topic_catalogue(spark, sf_dir):
    return landing.topic_catalogue(camera_landing(spark, sf_dir))


def latest_payloads(spark, sf_dir):
    return landing.latest_payloads(camera_landing(spark, sf_dir))


def dump_import(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id",
        f"CASE WHEN o_orderkey % 10 = 0 THEN '{landing.ZERO_DATE}' ELSE CAST(o_orderdate AS STRING) END as created",
        "CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END as amount",
    )
    return landing.cast_dump(raw, ["created"], ["amount"])


def csv_handoff(spark, sf_dir):
    path = scratch(spark, "handoff")
    rows = staged(spark, sf_dir).select("landing_id", "city", text.null_to_blank(F.col("lp")).alias("lp"), "velocity")
    delimited.write_handoff(rows, path)
    return delimited.read_handoff(spark, path, "landing_id long, city string, lp string, velocity int")


def batched_append(spark, sf_dir):
    path = scratch(spark, "appended")
    rows = camera_landing(spark, sf_dir).withColumn("parity", F.col("id") % 2)
    for parity in (0, 1):
        delimited.append_batch(rows.where(F.col("parity") == parity), path, "parity")
    return spark.read.parquet(path).groupBy("topic").agg(F.count("*").alias("messages"), F.max("id").alias("last_id"))


def week_chunks(spark, sf_dir):
    rows = loaded_warehouse(spark, sf_dir).facts()
    return rows.groupBy("week_bucket").agg(
        F.count("*").alias("detections"), F.min("time_key").alias("first_key"), F.max("time_key").alias("last_key")
    )


# ---- staging ------------------------------------------------------------------------


def camera_fields(spark, sf_dir):
    return staging.extract_fields(camera_landing(spark, sf_dir)).drop("time", "topic")


def city_rules(spark, sf_dir):
    topic = F.col("topic")
    return (
        camera_landing(spark, sf_dir)
        .groupBy(topic, text.city_from_topic(topic).alias("city"), text.city_by_position(topic).alias("city_part"))
        .agg(F.count("*").alias("messages"))
    )


def utc_times(spark, sf_dir):
    fields = staging.extract_fields(camera_landing(spark, sf_dir))
    return fields.select("id", timeparts.parse_utc(F.col("utc")).alias("utc"))


def number_rules(spark, sf_dir):
    fields = staging.extract_fields(camera_landing(spark, sf_dir))
    value = table(spark, sf_dir, "events").selectExpr("event_id + 1 as id", "CAST(value AS STRING) as value")
    mixed = F.when(F.col("id") % 3 == 0, F.concat("velocity", F.lit("f"))).otherwise(F.col("value"))
    return fields.join(value, "id").select(
        "id",
        numbers.whole_number(F.col("velocity")).alias("velocity_whole"),
        numbers.whole_number(F.col("value")).alias("value_whole"),
        numbers.truthy_number(F.col("velocity")).alias("velocity_truthy"),
        numbers.truthy_number(F.col("value")).alias("value_truthy"),
        numbers.number_or_null(mixed).alias("mixed_number"),
        numbers.number_or_zero(F.col("vehClass")).alias("class_or_zero"),
    )


def blank_rules(spark, sf_dir):
    fields = staging.extract_fields(camera_landing(spark, sf_dir))
    return fields.select(
        "id",
        text.null_to_blank(F.col("lp")).alias("lp_blank"),
        text.null_to_blank(F.col("detectionType")).alias("type_blank"),
        text.blank_to_null(F.col("lp")).alias("lp_null"),
        text.blank_to_null(F.col("sensor")).alias("sensor_trimmed"),
    )


def camera_staging(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return rows.withColumn("has_load_time", F.col("load_dttm").isNotNull()).drop("load_dttm")


def camera_staging_blanks(spark, sf_dir):
    return staging.camera_staging(camera_landing(spark, sf_dir), CLICKHOUSE).drop("load_dttm")


def staging_mark(spark, sf_dir):
    return staging.staging_mark(staged(spark, sf_dir))


def staging_rejects(spark, sf_dir):
    return staging.rejects(camera_landing(spark, sf_dir))


# ---- dimensions, from the staging table --------------------------------------------------


def distinct_members(spark, sf_dir):
    return dimensions.distinct_members(loaded_warehouse(spark, sf_dir).staging())


def member_counts(spark, sf_dir):
    return dimensions.member_counts(loaded_warehouse(spark, sf_dir).staging())


def _plates(spark, sf_dir):
    """Plates of all messages, and the plates of the first day as known members."""
    rows = loaded_warehouse(spark, sf_dir).staging()
    rows = rows.select("original_time", dimensions.natural_key("plate").alias("license_plate"))
    rows = rows.where("license_plate is not null")
    known = rows.where(F.col("original_time") < literal(FIRST_DAY_END)).select("license_plate").distinct()
    return rows.select("license_plate"), known


def new_members_except(spark, sf_dir):
    return dimensions.new_members_except(*_plates(spark, sf_dir))


def new_members_anti(spark, sf_dir):
    plates, known = _plates(spark, sf_dir)
    return dimensions.new_members(plates.distinct(), known, ["license_plate"])


def new_members_not_in(spark, sf_dir):
    plates, known = _plates(spark, sf_dir)
    return dimensions.new_members_not_in(plates.distinct(), known, "license_plate", "license_plate")


def added_members_twice(spark, sf_dir):
    plates, known = _plates(spark, sf_dir)
    once = dimensions.add_members(known, plates, "license_plate")
    return dimensions.add_members(once, plates, "license_plate")


def dense_keys(spark, sf_dir):
    return dimensions.dense_keys(member_counts(spark, sf_dir).drop("uses"))


def hash_keys(spark, sf_dir):
    keyed = dimensions.hash_keys(member_counts(spark, sf_dir))
    shared = dimensions.hash_collisions(keyed).groupBy("dimension").agg(F.count("*").alias("collisions"))
    return (
        keyed.groupBy("dimension").agg(F.count("*").alias("members")).join(shared, "dimension", "left")
        .na.fill(0, ["collisions"])
    )


def dimension_rows(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).members()


def calendar_days(spark, sf_dir):
    """The calendar per day, with the detections of the day (0 on quiet days)."""
    warehouse = loaded_warehouse(spark, sf_dir)
    per_minute = warehouse.facts().groupBy("time_key").agg(F.count("*").alias("detections"))
    return (
        warehouse.calendar().join(per_minute, "time_key", "left")
        .groupBy("year_num", "month_num", "day_num", "day_of_week_num")
        .agg(
            F.count("*").alias("minutes"),
            F.min("time_key").alias("first_key"),
            F.max("time_key").alias("last_key"),
            F.coalesce(F.sum("detections"), F.lit(0)).alias("detections"),
        )
    )


def calendar_variants(spark, sf_dir):
    """Detections per hour of the calendar with unix keys and Sunday-first weekdays."""
    per_minute = staged(spark, sf_dir).groupBy(
        timeparts.unix_seconds(timeparts.truncated(F.col("original_time"), "minute")).alias("time_key")
    ).agg(F.count("*").alias("detections"))
    return (
        dimensions.calendar(spark, keys="unix", weekdays="sunday").join(per_minute, "time_key")
        .groupBy("month_num", "day_num", "day_of_week_num", "hour_num")
        .agg(
            F.min("time_key").alias("first_key"),
            F.count("*").alias("busy_minutes"),
            F.sum("detections").alias("detections"),
        )
    )


def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    return dimensions.latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


def active_cities(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).dimension("city")


def reset_and_reload(spark, sf_dir):
    """Rows per table after a load, a reset and another load."""
    warehouse = Warehouse(prepare(spark), scratch(spark, "reset")).create()
    messages = camera_landing(spark, sf_dir)
    warehouse.load(messages, ALL_TOPICS)
    warehouse.reset()
    left = warehouse.members().groupBy(F.lit("members after reset").alias("what")).agg(F.count("*").alias("rows"))
    left = pinned(left.unionByName(warehouse.facts().agg(F.count("*").alias("rows")).withColumn("what", F.lit("facts after reset"))))
    warehouse.load(messages, ALL_TOPICS)
    for what, rows in (("members", warehouse.members()), ("facts", warehouse.facts()), ("staging", warehouse.staging())):
        left = left.unionByName(rows.agg(F.count("*").alias("rows")).withColumn("what", F.lit(what)))
    return left


def without_duplicates(spark, sf_dir):
    rows = loaded_warehouse(spark, sf_dir).staging().select("landing_id", "city", "velocity", "original_time")
    first = rows.withColumn("load_dttm", F.col("original_time"))
    later = rows.where("velocity > 50").withColumn("velocity", F.col("velocity") + 1)
    later = later.withColumn("load_dttm", F.col("original_time") + F.expr("interval 1 day"))
    return dimensions.without_duplicates(first.unionByName(later).unionByName(later))


# ---- facts ------------------------------------------------------------------------------


def fact_rows(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).facts().drop("week_bucket")


def _members_by_name(members):
    return {d: members.where(F.col("dimension") == d).select("member", "key") for d in dimensions.NATURAL_KEYS}


def profile_warehouse(spark: SparkSession, sf_dir: str, profile: Profile) -> Warehouse:
    """A warehouse by the rules of a variant, whose calendar ends before the messages do."""
    key = (spark.sparkContext.applicationId, sf_dir, profile.name)
    if key not in _warehouses:
        root = scratch(spark, f"warehouse-{profile.name}")
        warehouse = Warehouse(prepare(spark), root, profile, end=PROFILE_END).create()
        warehouse.load(camera_landing(spark, sf_dir), ALL_TOPICS)
        _warehouses[key] = warehouse
    return _warehouses[key]


def fact_rows_of(profile: Profile) -> Query:
    return lambda spark, sf_dir: profile_warehouse(spark, sf_dir, profile).facts().drop("week_bucket")


def member_rows_of(profile: Profile) -> Query:
    return lambda spark, sf_dir: profile_warehouse(spark, sf_dir, profile).members()


def minutes_of(profile: Profile) -> Query:
    """Detections per time key beside the variant's calendar row, where it has one."""

    def run(spark, sf_dir):
        warehouse = profile_warehouse(spark, sf_dir, profile)
        per_key = warehouse.facts().groupBy("time_key").agg(F.count("*").alias("detections"))
        return per_key.join(warehouse.calendar(), "time_key", "left")

    return run


def inner_lookup(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    return facts.star_lookup_inner(warehouse.staging(), _members_by_name(warehouse.members()), warehouse.calendar())


def salted_plate_lookup(spark, sf_dir):
    """Plates whose hot members are split, with a low bound on hot."""
    warehouse = loaded_warehouse(spark, sf_dir)
    rows = warehouse.staging().select("landing_id", "lp")
    plates = _members_by_name(warehouse.members())["plate"]
    hot = facts.hot_members(dimensions.member_counts(warehouse.staging()), "plate", hot_rows=1, task_rows=100)
    return facts.salted_lookup(rows, plates, hot, dimensions.natural_key("plate"), "lp_key", "landing_id")


def guarded_lookup(spark, sf_dir):
    rows = staging.camera_staging(camera_landing(spark, sf_dir), CLICKHOUSE)
    members = pinned(dimensions.dense_keys(dimensions.member_counts(rows).drop("uses")))
    return facts.star_lookup_guarded(rows, _members_by_name(members), CLICKHOUSE.unknown_key)


def time_by_parts(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    rows = warehouse.staging().select("landing_id", "original_time")
    return facts.with_time_key_by_parts(rows, warehouse.calendar())


def time_by_minute(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    rows = warehouse.staging().select("landing_id", "original_time")
    return facts.with_time_key_by_minute(rows, warehouse.calendar())


def batch_ranges(spark, sf_dir):
    return facts.batch_ranges(loaded_warehouse(spark, sf_dir).staging(), "landing_id", 1, BATCH)


def running_fact_keys(spark, sf_dir):
    rows = loaded_warehouse(spark, sf_dir).facts().select("camera_detection_key", "velocity")
    return facts.running_fact_keys(rows, 1000)


def uuid_fact_keys(spark, sf_dir):
    keyed = facts.uuid_fact_keys(loaded_warehouse(spark, sf_dir).facts())
    return keyed.agg(F.count("*").alias("rows"), F.count_distinct("fact_key").alias("keys"))


def load_reconciliation(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    return facts.reconcile(warehouse.staging(), warehouse.facts(), 1, BATCH)


def orphan_keys(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    known = {key: warehouse.dimension(d) for d, (key, _) in dimensions.DIMENSION_COLUMNS.items()}
    known["time_key"] = warehouse.calendar()
    return facts.orphan_keys(warehouse.facts(), known)


def duplicate_members(spark, sf_dir):
    """Duplicates among dimension members, next to a table that has some."""
    members = loaded_warehouse(spark, sf_dir).members().select("dimension", "member")
    events = table(spark, sf_dir, "events")
    repeated = events.select(F.lit("event_type").alias("dimension"), F.col("event_type").alias("member"))
    return facts.duplicate_members(members.unionByName(repeated))


def null_counts(spark, sf_dir):
    return facts.null_counts(loaded_warehouse(spark, sf_dir).facts())


def unknown_shares(spark, sf_dir):
    return facts.unknown_shares(loaded_warehouse(spark, sf_dir).facts())


# ---- control ------------------------------------------------------------------------------


def mark_history(spark, sf_dir):
    """Marks per topic and day; on odd days a late writer sets a low mark."""
    day = F.to_date("time")
    mark = F.when(F.max(F.dayofmonth("time")) % 2 == 1, F.min("id")).otherwise(F.max("id"))
    return (
        camera_landing(spark, sf_dir).groupBy("topic", day.alias("day"))
        .agg(mark.alias("last_loaded_id"), F.max("time").alias("last_update"))
        .select("topic", F.lit(control.STAGE_STEP).alias("process_step"), "last_loaded_id", "last_update")
    )


def high_water_marks(spark, sf_dir):
    """Marks of the warehouse: by its topic, and of the history by pattern."""
    warehouse = loaded_warehouse(spark, sf_dir)
    exact = control.high_water_mark(warehouse.control(), ALL_TOPICS).withColumn("topic", F.lit("all topics"))
    like = control.high_water_marks_like(mark_history(spark, sf_dir), CAMERA_PATTERN)
    none = control.high_water_mark(warehouse.control(), "no such topic").withColumn("topic", F.lit("no such topic"))
    return exact.unionByName(like.withColumn("topic", F.lit(CAMERA_PATTERN))).unionByName(none)


def _old_and_new(spark, sf_dir):
    history = mark_history(spark, sf_dir)
    border = literal(dt.datetime(2024, 1, 10))
    return history.where(F.col("last_update") < border), history.where(F.col("last_update") >= border)


def guarded_upsert(spark, sf_dir):
    return control.guarded_upsert(*_old_and_new(spark, sf_dir))


def plain_upsert(spark, sf_dir):
    return control.plain_upsert(*_old_and_new(spark, sf_dir))


def append_upsert(spark, sf_dir):
    return control.append_upsert(mark_history(spark, sf_dir))


def resume_range(spark, sf_dir):
    rows = loaded_warehouse(spark, sf_dir).staging()
    found = None
    for case, mark, limit in (("first", 0, 1000), ("next", 1000, 1_000_000_000), ("done", 1_000_000_000_000, 1000)):
        one = control.resume_range(rows, mark, limit).withColumn("case", F.lit(case))
        found = one if found is None else found.unionByName(one)
    return found


def run_log(spark, sf_dir):
    found = control.runs(loaded_warehouse(spark, sf_dir).run_events())
    ended = (F.col("end_time") >= F.col("start_time")).alias("has_ended")
    return found.select("job_name", "topic", "status", "rows_inserted", "rows_updated", "error_message", ended)


def load_progress(spark, sf_dir):
    rows = facts.with_batch(loaded_warehouse(spark, sf_dir).staging(), "landing_id", 1, BATCH)
    batches = rows.groupBy(F.lit("load").alias("job"), "batch_no").agg(
        F.count("*").alias("rows"), (F.coalesce(F.sum("velocity"), F.lit(0)) + 1).alias("seconds")
    )
    return control.progress(batches)


def streamed_facts(spark, sf_dir):
    """The incremental load as a stream of several files, labels in place of keys."""
    root = scratch(spark, "stream")
    camera_landing(spark, sf_dir).repartition(3, "id").write.parquet(f"{root}/landing")
    warehouse = Warehouse(prepare(spark), f"{root}/warehouse").create()
    stream_load(spark, f"{root}/landing", warehouse, ALL_TOPICS, f"{root}/checkpoint", files_per_batch=2)
    return semantic.camera_cube(warehouse).details(
        ["id", "velocity", "city_name", "country_code", "sensor_code", "vehicle_class", "license_plate", "detection_type"]
    )


def stepwise_warehouse(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, RollupStore]:
    """A warehouse loaded in steps, with compactions, a vacuum and refreshed roll-ups
    between them. The last step is neither compacted nor in the roll-ups yet."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stepwise:
        root = scratch(spark, "stepwise")
        warehouse = Warehouse(prepare(spark), f"{root}/warehouse").create()
        kept = RollupStore(warehouse, semantic.camera_cube(warehouse), f"{root}/rollups", ROLLUPS).create()
        messages = camera_landing(spark, sf_dir)
        last = messages.agg(F.max("id")).first()[0]
        for step in range(1, LOAD_STEPS + 1):
            warehouse.load(messages, ALL_TOPICS, up_to_id=last * step // LOAD_STEPS)
            if step < LOAD_STEPS:
                kept.refresh()
                warehouse.compact()
                warehouse.vacuum()
        _stepwise[key] = warehouse, kept
    return _stepwise[key]


def compacted_facts(spark, sf_dir):
    """Facts of several loads after compactions, labels in place of keys."""
    return semantic.camera_cube(stepwise_warehouse(spark, sf_dir)[0]).details(
        ["id", "velocity", "week_bucket", "city_name", "country_code", "sensor_code", "vehicle_class", "license_plate", "detection_type"]
    )


def kept_rollup(spark, sf_dir):
    """Velocities per city and day of one country, from the smallest roll-up that covers
    them and the facts of the last load."""
    found = stepwise_warehouse(spark, sf_dir)[1].query(
        ["avg_velocity", "detections", "max_velocity", "min_velocity"], ["city_name", "day"], [Filter("country_code", "equals", "CZ")]
    )
    return found.withColumn("avg_velocity", F.round("avg_velocity", 6))


# ---- benchmark questions ----------------------------------------------------------------------


def velocity_by_class(spark, sf_dir):
    return analytics.velocity_by_class(cube(spark, sf_dir))


def detections_by_time(spark, sf_dir):
    return analytics.detections_by_time(cube(spark, sf_dir))


def detections_by_day(spark, sf_dir):
    return analytics.detections_by_time(cube(spark, sf_dir), "day")


def fastest_cities(spark, sf_dir):
    return analytics.fastest_cities(cube(spark, sf_dir))


def velocity_by_type_and_class(spark, sf_dir):
    return analytics.velocity_by_type_and_class(cube(spark, sf_dir))


def weekend_city_ranks(spark, sf_dir):
    return analytics.weekend_city_ranks(cube(spark, sf_dir))


# ---- semantic layer -------------------------------------------------------------------------------

MEASURE_GROUPS = ["city_name", "vehicle_class"]


def measure_query(name: str) -> Query:
    def run(spark, sf_dir):
        found = cube(spark, sf_dir).query([name], MEASURE_GROUPS)
        return found.withColumn(name, F.round(name, 6)) if "avg" in name or "average" in name else found

    return run


def dimension_query(name: str) -> Query:
    def run(spark, sf_dir):
        return cube(spark, sf_dir).query(["detections"], [name])

    return run


def grain_query(grain: str) -> Query:
    def run(spark, sf_dir):
        return cube(spark, sf_dir).query(["detections", "max_velocity"], ["full_date"], grain=grain)

    return run


def all_measures_total(spark, sf_dir):
    measures = [m.name for m in semantic.MEASURES]
    found = cube(spark, sf_dir).query(measures)
    return found.select(*[F.round(m, 6).alias(m) if "avg" in m or "average" in m else F.col(m) for m in measures])


def measure_ignoring_filter(spark, sf_dir):
    found = cube(spark, sf_dir).query(
        ["velocity_average_moving", "avg_velocity", "detections"], ["vehicle_class"], [Filter("velocity", "gt", 50)]
    )
    return found.withColumns({m: F.round(m, 6) for m in ("velocity_average_moving", "avg_velocity")})


def filtered_cube(spark, sf_dir):
    window = semantic.between(dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 23, 12))
    filters = [*window, Filter("country_code", "not_equals", "D"), Filter("velocity", "set")]
    return cube(spark, sf_dir).query(
        ["detections", "unique_plates", "sum_velocity"], ["city_name", "weekday", "hour"], filters
    )


def date_rollup(spark, sf_dir):
    return cube(spark, sf_dir).rollup(["detections", "max_velocity"], "date")


def time_rollup(spark, sf_dir):
    return cube(spark, sf_dir).rollup(["detections", "unique_plates"], "time")


def date_drill(spark, sf_dir):
    return cube(spark, sf_dir).drill("date", [2024, 1], ["detections"])


def drill_members(spark, sf_dir):
    return cube(spark, sf_dir).details(["id", "full_date", "license_plate"], [Filter("city_name", "equals", "Decin")])


def data_mart(spark, sf_dir):
    members = {"facts": ["id", "velocity"], "city": ["city_name"], "country": ["country_code"], "calendar": ["year", "month_name"]}
    return cube(spark, sf_dir).view(members)


def stored_rollup(spark, sf_dir):
    """Average per city from a roll-up stored per city, class and day."""
    path = scratch(spark, "rollup")
    measures = ["avg_velocity", "detections", "max_velocity"]
    camera = cube(spark, sf_dir)
    camera.build_rollup(measures, ["city_name", "vehicle_class", "day"], path)
    found = camera.from_rollup(spark, path, measures, ["city_name"])
    return found.withColumn("avg_velocity", F.round("avg_velocity", 6))


def model_partitions(spark, sf_dir):
    """Rows per imported model table."""
    warehouse = loaded_warehouse(spark, sf_dir)
    found = None
    for name in ("facts", "calendar", *dimensions.DIMENSION_COLUMNS):
        rows = semantic.table_partition(warehouse, name)
        one = rows.agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found


def run_monitor(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    monitor = semantic.monitor_cube(lambda: control.runs(warehouse.run_events()), semantic.RUN_MEMBERS)
    return monitor.query(["count"], ["job_name", "topic", "status"])


def control_monitor(spark, sf_dir):
    history = lambda: mark_history(spark, sf_dir)
    return semantic.monitor_cube(history, semantic.CONTROL_MEMBERS).query(["count"], ["topic", "last_update"])


def staging_monitor(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    monitor = semantic.monitor_cube(warehouse.staging, semantic.STAGING_MEMBERS)
    return monitor.query(["count"], ["city", "detection_type", "sensor", "ilpc"])


def camera_queries() -> dict[str, Query]:
    plain = [
        incremental_scan, topic_scan, topic_catalogue, latest_payloads, dump_import, csv_handoff, batched_append,
        week_chunks, camera_fields, city_rules, utc_times, number_rules, blank_rules, camera_staging,
        camera_staging_blanks, staging_mark, staging_rejects, distinct_members, member_counts, new_members_except,
        new_members_anti, new_members_not_in, added_members_twice, dense_keys, hash_keys, dimension_rows,
        calendar_days, calendar_variants, latest_per_key, active_cities, reset_and_reload, without_duplicates,
        fact_rows, inner_lookup, salted_plate_lookup, guarded_lookup, time_by_parts, time_by_minute, batch_ranges,
        running_fact_keys, uuid_fact_keys, load_reconciliation, orphan_keys, duplicate_members, null_counts,
        unknown_shares, high_water_marks, guarded_upsert, plain_upsert, append_upsert, resume_range, run_log,
        load_progress, streamed_facts, compacted_facts, kept_rollup, velocity_by_class, detections_by_time, detections_by_day, fastest_cities,
        velocity_by_type_and_class, weekend_city_ranks, all_measures_total, measure_ignoring_filter, filtered_cube,
        date_rollup, time_rollup, date_drill, drill_members, data_mart, stored_rollup, model_partitions,
        run_monitor, control_monitor, staging_monitor,
    ]
    found: dict[str, Query] = {query.__name__: query for query in plain}
    for profile in PROFILES.values():
        if profile != CANON:
            found[f"fact_rows_{profile.name}"] = fact_rows_of(profile)
            found[f"member_rows_{profile.name}"] = member_rows_of(profile)
            found[f"minutes_{profile.name}"] = minutes_of(profile)
    found.update({f"measure_{m.name}": measure_query(m.name) for m in semantic.MEASURES})
    found.update({f"by_{d.name}": dimension_query(d.name) for d in semantic.DIMENSIONS})
    found.update({f"per_{grain}": grain_query(grain) for grain in ("minute", "hour", "day", "week", "month", "quarter", "year")})
    return found
