"""Fact loading: star key lookups, batches, reconciliation, integrity checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstar.functions import numbers, timeparts
from sensorstar.operators.dimensions import DIMENSION_COLUMNS, first_time_key, lookup_key, natural_key
from sensorstar.operators.numbering import number_rows
from sensorstar.plans.profiles import CANON, Profile
from sensorstar.session import broadcast_up_to, literal_rows

FACT_SCHEMA = (
    "camera_detection_key long, time_key int, sensor_key long, detection_type_key long, lp_key long, "
    "country_key long, vehicle_class_key long, city_key long, velocity double, detection_time timestamp_ntz"
)
FACT_COLUMNS = [part.split()[0] for part in FACT_SCHEMA.split(", ")]
KEY_COLUMNS = {d: key for d, (key, _) in DIMENSION_COLUMNS.items()}

# At most this many members can each hold 1/HOT_SHARE of all rows, which bounds
# the table of hot members that is broadcast.
HOT_SHARE = 1000
HOT_ROWS = 1_000_000
# Rows of a hot member that one task takes.
TASK_ROWS = 1_000_000
# Dimensions of at most this many members are broadcast by the planner.
SMALL_DIMENSION = 100_000


def hot_members(
    counts: DataFrame, dimension: str | None = None, hot_rows: int = HOT_ROWS, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``(dimension, member, salts)``: members of one or all dimensions that hold a large
    share of its rows (at most ``HOT_SHARE`` of them), and into how many parts each is cut."""
    uses = counts if dimension is None else counts.where(F.col("dimension") == dimension)
    # one row per dimension
    totals = uses.groupBy("dimension").agg(F.sum("uses").alias("_total"))
    hot = uses.join(F.broadcast(totals), "dimension")
    hot = hot.where((F.col("uses") * HOT_SHARE >= F.col("_total")) & (F.col("uses") >= hot_rows))
    return hot.select("dimension", "member", F.ceil(F.col("uses") / task_rows).cast("int").alias("salts"))


def salted_lookup(
    rows: DataFrame, members: DataFrame, hot: DataFrame, member: Column, key: str, spread_by: str
) -> DataFrame:
    """Left join to a large dimension whose hot members ``(member, salts)`` are split over
    tasks.

    A row of a hot member gets one of the member's salts; the member is repeated once per
    salt, so each task gets about as many rows as the salts were measured for. Rows without
    a member meet nothing and spread over all tasks. Other rows keep salt 0.
    """
    spread = F.xxhash64(spread_by)
    marked = hot.select(F.col("member").alias("_member"), F.col("salts").alias("_salts"))
    left = rows.withColumn("_member", member).join(F.broadcast(marked), "_member", "left")
    salt = F.when(F.col("_member").isNull(), spread).otherwise(F.pmod(spread, F.coalesce("_salts", F.lit(1)).cast("long")))
    left = left.withColumn("_salt", salt)
    salts = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1)
    right = (
        members.select(F.col("member").alias("_member"), F.col("key").alias(key))
        .join(F.broadcast(marked), "_member", "left")
        .select("_member", key, F.explode(salts).alias("_salt"))
    )
    return left.join(right, ["_member", "_salt"], "left").drop("_member", "_salt", "_salts")


def fact_schema(profile: Profile = CANON) -> str:
    """Seconds since 1970 need more room than minutes."""
    return FACT_SCHEMA.replace("time_key int", "time_key long") if profile.time_keys == "unix" else FACT_SCHEMA


def profile_time_key(ts: Column, profile: Profile, start: dt.date, end: dt.date) -> Column:
    if profile.time_keys == "unix":
        return timeparts.unix_seconds(ts)
    return timeparts.time_key(ts, start, end, first_time_key(profile.time_keys), profile.missing_minutes)


def profile_velocity(velocity: Column, profile: Profile) -> Column:
    return numbers.number_or_zero(velocity) if profile.velocity == "zero" else velocity.cast("double")


def unloadable(staging: DataFrame, profile: Profile) -> DataFrame:
    """Staging rows that cannot become facts: those without a velocity that is required."""
    return staging.where(F.col("velocity").isNull() & F.lit(profile.velocity == "required"))


def star_lookup(
    staging: DataFrame,
    members: Mapping[str, DataFrame],
    hot: DataFrame,
    profile: Profile = CANON,
    start: dt.date = timeparts.CALENDAR_START,
    end: dt.date = timeparts.CALENDAR_END,
    split: Collection[str] = ("plate",),
) -> DataFrame:
    """Fact rows by the rules of ``profile``: every staging row with its seven keys; a
    missing member, and key 0, gets the unknown key. The minute key is arithmetic over the
    calendar's range and needs no join. The hot members ``(dimension, member, salts)`` of
    the dimensions in ``split`` are cut into parts."""
    rows = staging
    if profile.velocity == "required":
        rows = rows.where(F.col("velocity").isNotNull())
    for name, key in KEY_COLUMNS.items():
        text = lookup_key(name, profile.members)
        if name in split:
            rows = salted_lookup(rows, members[name], hot.where(F.col("dimension") == name), text, key, "landing_id")
        else:
            right = members[name].select(F.col("member").alias("_member"), F.col("key").alias(key))
            rows = rows.join(right, text == F.col("_member"), "left").drop("_member")
    unknown = F.lit(profile.unknown_key).cast("long")
    keys = [F.coalesce(F.nullif(F.col(k), F.lit(0)), unknown).alias(k) for k in KEY_COLUMNS.values()]
    return rows.select(
        F.col("landing_id").alias("camera_detection_key"),
        profile_time_key(F.col("original_time"), profile, start, end).alias("time_key"),
        *keys,
        profile_velocity(F.col("velocity"), profile).alias("velocity"),
        F.col("original_time").alias("detection_time"),
    ).select(*FACT_COLUMNS)


def star_lookup_inner(staging: DataFrame, members: Mapping[str, DataFrame], calendar: DataFrame) -> DataFrame:
    """Older rule: a row without all of its members is dropped; no city key."""
    rows = staging
    for name, key in KEY_COLUMNS.items():
        if name != "city":
            right = members[name].select(F.col("member").alias("_member"), F.col("key").alias(key))
            rows = rows.join(right, natural_key(name) == F.col("_member")).drop("_member")
    rows = with_time_key_by_parts(rows, calendar, "inner")
    keys = [k for k in KEY_COLUMNS.values() if k != "city_key"]
    return rows.select(F.col("landing_id").alias("camera_detection_key"), "time_key", *keys, "velocity")


def star_lookup_guarded(staging: DataFrame, members: Mapping[str, DataFrame], unknown_key: int) -> DataFrame:
    """Variant with blank texts instead of NULLs: a blank never joins, key 0 and
    no key are unknown, time keys are seconds and a missing velocity is 0."""
    rows = staging
    for name, key in KEY_COLUMNS.items():
        right = members[name].select(F.col("member").alias("_member"), F.col("key").alias(key))
        value = natural_key(name)
        rows = rows.join(right, value.isNotNull() & (value == F.col("_member")), "left").drop("_member")
    unknown = F.lit(unknown_key).cast("long")
    keys = [
        F.when(F.col(k).isNull() | (F.col(k) == 0), unknown).otherwise(F.col(k)).alias(k)
        for k in KEY_COLUMNS.values()
    ]
    return rows.select(
        F.col("landing_id").alias("camera_detection_key"),
        timeparts.unix_seconds(F.col("original_time")).alias("time_key"),
        *keys,
        numbers.number_or_zero(F.col("velocity")).alias("velocity"),
    )


def with_time_key_by_parts(rows: DataFrame, calendar: DataFrame, how: str = "left") -> DataFrame:
    """Time lookup on (date, hour, minute).

    The calendar has one row per minute of its date range, whatever the number
    of facts; it is broadcast while that is small.
    """
    minutes = calendar.where(F.col("time_key") >= 0).select(
        "time_key",
        F.to_date("full_date").alias("_day"),
        F.col("hour_num").alias("_hour"),
        F.col("minute_num").alias("_minute"),
    )
    at = F.col("original_time")
    same = (
        (F.to_date(at) == F.col("_day")) & (F.hour(at) == F.col("_hour")) & (F.minute(at) == F.col("_minute"))
    )
    return (
        rows.join(broadcast_up_to(minutes, calendar.count()), same, how)
        .withColumn("time_key", F.coalesce("time_key", F.lit(timeparts.UNKNOWN_KEY)))
        .drop("_day", "_hour", "_minute")
    )


def with_time_key_by_minute(rows: DataFrame, calendar: DataFrame, how: str = "left") -> DataFrame:
    """Time lookup on the time cut to its minute; the calendar is joined as above."""
    minutes = calendar.where(F.col("time_key") >= 0).select("time_key", F.col("full_date").alias("_minute"))
    cut = timeparts.truncated(F.col("original_time"), "minute")
    return (
        rows.join(broadcast_up_to(minutes, calendar.count()), cut == F.col("_minute"), how)
        .withColumn("time_key", F.coalesce("time_key", F.lit(timeparts.UNKNOWN_KEY)))
        .drop("_minute")
    )


def with_batch(rows: DataFrame, id_column: str, lowest: int, size: int) -> DataFrame:
    """Number of the id range a row belongs to."""
    return rows.withColumn("batch_no", F.floor((F.col(id_column) - lowest) / size))


def batch_ranges(rows: DataFrame, id_column: str, lowest: int, size: int) -> DataFrame:
    """First id, last id and row count of every non-empty batch."""
    start = F.col("batch_no") * size + lowest
    return (
        with_batch(rows, id_column, lowest, size)
        .groupBy("batch_no")
        .agg(F.count("*").alias("rows"), F.max(id_column).alias("highest_id"))
        .select("batch_no", start.alias("first_id"), (start + size - 1).alias("last_id"), "highest_id", "rows")
    )


def running_fact_keys(facts: DataFrame, highest_key: int = 0) -> DataFrame:
    """Dense fact keys in landing order, after the highest key in use."""
    numbered = number_rows(facts, ["camera_detection_key"], "fact_key")
    return numbered.withColumn("fact_key", F.col("fact_key") + highest_key)


def uuid_fact_keys(facts: DataFrame) -> DataFrame:
    return facts.withColumn("fact_key", F.expr("uuid()"))


def reconcile(staging: DataFrame, facts: DataFrame, lowest: int, size: int) -> DataFrame:
    """Per batch: staged rows, loaded rows and how many are missing."""
    staged = with_batch(staging, "landing_id", lowest, size).groupBy("batch_no").agg(F.count("*").alias("staged"))
    loaded = (
        with_batch(facts, "camera_detection_key", lowest, size).groupBy("batch_no").agg(F.count("*").alias("loaded"))
    )
    both = staged.join(loaded, "batch_no", "full").na.fill(0, ["staged", "loaded"])
    return both.withColumn("missing", F.col("staged") - F.col("loaded"))


def orphan_keys(facts: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension: fact rows whose key has no dimension row.

    ``dimensions`` maps a key column to its dimension. The keys of all columns are stacked
    and counted in one scan of the facts, each task counting its own first; one anti join
    then sees distinct keys only.
    """
    pairs = ", ".join(f"'{key}', CAST({key} AS BIGINT)" for key in dimensions)
    stacked = facts.selectExpr(f"stack({len(dimensions)}, {pairs}) as (key_column, key)")
    per_key = stacked.groupBy("key_column", "key").agg(F.count("*").alias("rows"))
    known = reduce(
        DataFrame.unionByName,
        [rows.select(F.lit(key).alias("key_column"), F.col(key).cast("long").alias("key")) for key, rows in dimensions.items()],
    )
    orphans = per_key.join(known, ["key_column", "key"], "left_anti")
    counted = orphans.groupBy("key_column").agg(F.count("*").alias("orphan_keys"), F.sum("rows").alias("orphan_rows"))
    columns = literal_rows(facts.sparkSession, "key_column string", [(key,) for key in dimensions])
    return columns.join(F.broadcast(counted), "key_column", "left").na.fill(0, ["orphan_keys", "orphan_rows"])


def duplicate_members(members: DataFrame) -> DataFrame:
    """Natural keys that occur more than once in a dimension."""
    return members.groupBy("dimension", "member").agg(F.count("*").alias("copies")).where("copies > 1")


def null_counts(facts: DataFrame) -> DataFrame:
    """Per column: rows without a value."""
    counts = facts.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FACT_COLUMNS])
    pairs = ", ".join(f"'{c}', {c}" for c in FACT_COLUMNS)
    return counts.selectExpr(f"stack({len(FACT_COLUMNS)}, {pairs}) as (column_name, nulls)")


def unknown_shares(facts: DataFrame, unknown_key: int = -1) -> DataFrame:
    """Per key column: rows and share of rows that fell to the unknown member."""
    keys = ["time_key", *KEY_COLUMNS.values()]
    counts = facts.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(k) == unknown_key).alias(k) for k in keys])
    pairs = ", ".join(f"'{k}', {k}" for k in keys)
    return counts.selectExpr("_rows", f"stack({len(keys)}, {pairs}) as (key_column, unknown_rows)").select(
        "key_column", "unknown_rows", F.round(F.col("unknown_rows") / F.col("_rows"), 6).alias("unknown_share")
    )
