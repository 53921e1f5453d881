"""Dimension members: extraction, new members, keys, unknown rows, calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.functions import timeparts
from sensorstar.operators.numbering import number_rows_within
from sensorstar.plans.profiles import CANON, Profile
from sensorstar.session import broadcast_up_to, literal, literal_rows, pinned

# dimension -> staging column that holds its natural key
NATURAL_KEYS = {
    "city": "city",
    "sensor": "sensor",
    "plate": "lp",
    "detection_type": "detection_type",
    "vehicle_class": "veh_class",
    "country": "ilpc",
}
# dimension -> (key column, label column)
DIMENSION_COLUMNS = {
    "city": ("city_key", "city_name"),
    "sensor": ("sensor_key", "sensor_code"),
    "plate": ("lp_key", "license_plate"),
    "detection_type": ("detection_type_key", "detection_type"),
    "vehicle_class": ("vehicle_class_key", "vehicle_class"),
    "country": ("country_key", "country_code"),
}


def natural_key(name: str, members: str = "trimmed") -> Column:
    """The text that makes a member of dimension ``name`` of a staging row. Members that
    are taken as they are may hold blanks; numbers have none."""
    text = F.col(NATURAL_KEYS[name]).cast("string")
    return F.nullif(F.trim(text) if members == "trimmed" else text, F.lit(""))


def lookup_key(name: str, members: str = "trimmed") -> Column:
    """The text a staging row is looked up by: the same, but a blank one finds nothing."""
    key = natural_key(name, members)
    return key if members == "trimmed" else F.when(F.trim(key) != "", key)


def distinct_members(staging: DataFrame) -> DataFrame:
    """Every combination of the six natural keys, once."""
    return staging.select(*[natural_key(d).alias(d) for d in NATURAL_KEYS]).distinct()


def member_counts(staging: DataFrame, members: str = "trimmed") -> DataFrame:
    """``(dimension, member, uses)`` of all six dimensions from one scan.

    Every task counts its own members first, so the shuffle carries distinct
    members, not rows. The counts also tell which members are hot.
    """
    pairs = ", ".join(f"'{d}', _{d}" for d in NATURAL_KEYS)
    return (
        staging.select(*[natural_key(d, members).alias(f"_{d}") for d in NATURAL_KEYS])
        .selectExpr(f"stack({len(NATURAL_KEYS)}, {pairs}) as (dimension, member)")
        .where("member is not null")
        .groupBy("dimension", "member")
        .agg(F.count("*").alias("uses"))
    )


def new_members(members: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Members that are not in the dimension yet."""
    return members.join(known.select(*on), list(on), "left_anti")


def new_members_except(members: DataFrame, known: DataFrame) -> DataFrame:
    """The same by set difference; NULL counts as a value and duplicates vanish."""
    return members.subtract(known)


def new_members_not_in(members: DataFrame, known: DataFrame, member: str, known_member: str) -> DataFrame:
    """``member NOT IN (known labels)`` for labels that are never NULL.

    Written with ``NOT EXISTS``, which is the same without NULLs: for ``NOT IN``
    itself Spark would broadcast all known members, however many there are.
    """
    return members.sparkSession.sql(
        f"""SELECT * FROM {{members}} AS m WHERE m.{member} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {{known}} AS k WHERE k.{known_member} = m.{member})""",
        members=members,
        known=known,
    )


def add_members(known: DataFrame, candidates: DataFrame, member: str) -> DataFrame:
    """Insert what is missing, leave what exists: running it again adds nothing."""
    fresh = new_members(candidates.distinct(), known, [member])
    return known.unionByName(fresh, allowMissingColumns=True)


def dense_keys(members: DataFrame, highest: DataFrame | None = None) -> DataFrame:
    """Keys 1, 2, 3 … per dimension in member order, after the highest key in use."""
    numbered = number_rows_within(members, ["dimension"], ["member"], "key")
    if highest is None:
        return numbered
    # one row per dimension
    return (
        numbered.join(F.broadcast(highest), "dimension", "left")
        .withColumn("key", F.col("key") + F.coalesce("highest_key", F.lit(0)))
        .drop("highest_key")
    )


def hash_keys(members: DataFrame) -> DataFrame:
    """64-bit keys that depend on the member only; no counter, no lookup."""
    return members.withColumn("key", F.xxhash64("dimension", "member"))


def hash_collisions(keyed: DataFrame) -> DataFrame:
    """Keys two members share."""
    return (
        keyed.groupBy("dimension", "key").agg(F.count_distinct("member").alias("members")).where("members > 1")
    )


def unknown_members(spark: SparkSession, profile: Profile = CANON) -> DataFrame:
    """The row facts point to when a natural key is missing."""
    special = {"country": profile.unknown_country, "vehicle_class": profile.unknown_class}
    rows = [(d, special.get(d, profile.unknown_label), profile.unknown_key) for d in NATURAL_KEYS]
    return literal_rows(spark, "dimension string, member string, key long", rows)


def unknown_time(spark: SparkSession, profile: Profile = CANON) -> DataFrame:
    """The calendar row of times outside the calendar; a variant may have none."""
    values = [(timeparts.UNKNOWN_KEY, *profile.unknown_time)] if profile.unknown_time else []
    return literal_rows(spark, CALENDAR_SCHEMA, values)


def with_unknown(dimension: DataFrame, unknown: DataFrame, key: str) -> DataFrame:
    """Add the unknown row unless the dimension has it."""
    return dimension.unionByName(unknown.join(dimension.select(key), key, "left_anti").select(*dimension.columns))


CALENDAR_SCHEMA = (
    "time_key int, full_date timestamp_ntz, year_num int, month_num int, "
    "day_num int, day_of_week_num int, hour_num int, minute_num int"
)


def first_time_key(keys: str) -> int:
    return 1 if keys == "identity" else timeparts.FIRST_TIME_KEY


def calendar(
    spark: SparkSession,
    start: dt.date = timeparts.CALENDAR_START,
    end: dt.date = timeparts.CALENDAR_END,
    keys: str = "ordinal",
    weekdays: str = "iso",
    full_date: str = "minute",
    missing_minutes: int = 0,
) -> DataFrame:
    """One row per minute from ``start`` up to ``end`` (exclusive), without the
    ``missing_minutes`` before the end.

    ``keys`` is ``ordinal`` (first key plus position), ``identity`` (from 1) or ``unix``
    (seconds); ``weekdays`` is ``iso`` (1 = Monday) or ``sunday`` (1 = Sunday);
    ``full_date`` is the ``minute`` or its ``day``.
    """
    minutes = spark.range((end - start).days * timeparts.MINUTES_PER_DAY - missing_minutes)
    minute = literal(dt.datetime.combine(start, dt.time())) + F.make_dt_interval(mins=F.col("id").cast("int"))
    at = F.col("_at")
    key = timeparts.unix_seconds(at) if keys == "unix" else F.col("id") + first_time_key(keys)
    weekday = F.dayofweek(at) if weekdays == "sunday" else timeparts.iso_weekday(at)
    return minutes.select(F.col("id"), minute.alias("_at")).select(
        key.cast("int").alias("time_key"),
        (timeparts.truncated(at, "day") if full_date == "day" else at).alias("full_date"),
        F.year(at).alias("year_num"),
        F.month(at).alias("month_num"),
        F.dayofmonth(at).alias("day_num"),
        weekday.cast("int").alias("day_of_week_num"),
        F.hour(at).alias("hour_num"),
        F.minute(at).alias("minute_num"),
    )


def profile_calendar(spark: SparkSession, profile: Profile, start: dt.date, end: dt.date) -> DataFrame:
    """The calendar of a variant, with its row for unknown times."""
    minutes = calendar(spark, start, end, profile.time_keys, profile.weekdays, profile.full_date, profile.missing_minutes)
    return with_unknown(minutes, unknown_time(spark, profile), "time_key")


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The newest row of every key; of equal ones the largest. Nulls are a key like others.

    Keys and versions alone are aggregated, without the rows. Keys with one row pass
    through as they are. The others meet their newest version, which is broadcast while
    there are few, so that whole rows are neither sorted nor shuffled.
    """
    newest = F.max(F.struct(*version)).alias("_newest")
    narrow = df.select(*dict.fromkeys([*keys, *version])).groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
    several = narrow.agg(newest, F.count("*").alias("_rows")).where(F.col("_rows") > 1).drop("_rows")
    several = pinned(several)
    several = broadcast_up_to(several, several.count())
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    alone = df.join(several, same, "left_anti")
    latest = df.join(several, same & F.struct(*version).eqNullSafe(F.col("_newest"))).select(*df.columns)
    return alone.unionByName(largest_per_key(latest, keys))


def largest_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One of the few rows that a key has left, by hash."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    found = rows.groupBy(*keys).agg(F.array_max(F.collect_set(F.struct(*rest))).alias("_row"))
    return found.select(*keys, "_row.*").select(*rows.columns)


def active_cities(cities: DataFrame) -> DataFrame:
    return cities.withColumn("is_active", F.lit(True))


def without_duplicates(staging: DataFrame) -> DataFrame:
    """One staging row per landing id, the one loaded last."""
    return latest_per_key(staging, ["landing_id"], ["load_dttm"])
