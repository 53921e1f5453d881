"""Lake to staging for camera messages: parse, type, clean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.functions import numbers, payload, text, timeparts
from sensorstar.plans.profiles import CANON, Profile

STAGING_SCHEMA = (
    "landing_id long, original_time timestamp_ntz, city string, detection_type string, "
    "utc timestamp_ntz, lp string, sensor string, veh_class int, ilpc string, velocity int, "
    "load_dttm timestamp"
)
STAGING_COLUMNS = [part.split()[0] for part in STAGING_SCHEMA.split(", ")]


def extract_fields(landing: DataFrame) -> DataFrame:
    """The seven payload fields as text beside ``id, time, topic``.

    A payload that is not one JSON object gives NULL fields and keeps its row.
    """
    listed = landing.withColumn("_listed", payload.camera_list(F.col("payload")))
    field = F.when(F.size("_listed") == 1, F.col("_listed")[0])
    names = [part.split()[0] for part in payload.CAMERA_STRUCT.split(", ")]
    return listed.select("id", "time", "topic", *[field[name].alias(name) for name in names])


def camera_staging(landing: DataFrame, profile: Profile = CANON) -> DataFrame:
    """Typed staging rows; one output row per message, no shuffle."""
    fields = extract_fields(landing)
    number = numbers.truthy_number if profile.numbers == "truthy" else numbers.whole_number
    clean = text.null_to_blank if profile.blanks == "empty" else text.blank_to_null
    city = text.city_by_position if profile.city_rule == "position" else text.city_from_topic
    return fields.select(
        F.col("id").alias("landing_id"),
        F.col("time").alias("original_time"),
        city(F.col("topic")).alias("city"),
        clean(F.col("detectionType")).alias("detection_type"),
        timeparts.parse_utc(F.col("utc")).alias("utc"),
        clean(F.col("lp")).alias("lp"),
        clean(F.col("sensor")).alias("sensor"),
        number(F.col("vehClass")).alias("veh_class"),
        clean(F.col("ilpc")).alias("ilpc"),
        number(F.col("velocity")).alias("velocity"),
        F.current_timestamp().alias("load_dttm"),
    )


def staging_mark(staging: DataFrame) -> DataFrame:
    """Rows staged and the highest landing id among them."""
    return staging.agg(
        F.count("*").alias("rows_inserted"), F.coalesce(F.max("landing_id"), F.lit(0)).alias("max_landing_id")
    )


def rejects(landing: DataFrame) -> DataFrame:
    """Per topic: messages whose payload, class or velocity could not be read."""
    fields = extract_fields(landing)
    bad_payload = F.coalesce("detectionType", "utc", "lp", "sensor", "vehClass", "ilpc", "velocity").isNull()
    bad_class = F.col("vehClass").isNotNull() & numbers.whole_number(F.col("vehClass")).isNull()
    bad_velocity = F.col("velocity").isNotNull() & numbers.whole_number(F.col("velocity")).isNull()
    return fields.groupBy("topic").agg(
        F.count("*").alias("messages"),
        F.count_if(bad_payload).alias("bad_payloads"),
        F.count_if(bad_class).alias("bad_classes"),
        F.count_if(bad_velocity).alias("bad_velocities"),
    )
