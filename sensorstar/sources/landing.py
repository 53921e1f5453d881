"""Reading the landing messages ``(id, time, topic, payload)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.session import broadcast_counted, pinned

LANDING_SCHEMA = "id long, time timestamp_ntz, topic string, payload string"
# Fixed value: how some databases write a missing date.
ZERO_DATE = "0000-00-00 00:00:00"


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING_SCHEMA).parquet(path)


def read_landing_jdbc(
    spark: SparkSession, url: str, table: str, lowest: int, highest: int, slices: int, **options: str
) -> DataFrame:
    """A landing table of a database, read in id slices by the executors."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="id", lowerBound=str(lowest))
        .options(upperBound=str(highest), numPartitions=str(slices), **options)
        .load()
    )


def incremental_scan(landing: DataFrame, topic_pattern: str, after_id: int) -> DataFrame:
    """Messages of a topic pattern that came after the high-water mark."""
    return landing.where(F.col("topic").like(topic_pattern) & (F.col("id") > after_id))


def topic_scan(landing: DataFrame, topics: Sequence[str]) -> DataFrame:
    return landing.where(F.col("topic").isin(*topics))


def topic_catalogue(landing: DataFrame) -> DataFrame:
    return landing.select("topic").distinct()


def latest_payloads(landing: DataFrame) -> DataFrame:
    """The newest non-null payload of every topic; of equal ids the largest payload.

    The newest id of each topic is found by hash, without the payloads. One message a
    topic then meets it, so payloads are neither sorted nor, while the topics are few
    enough to be broadcast, shuffled.
    """
    messages = landing.where(F.col("payload").isNotNull()).select("topic", "id", "payload")
    newest = pinned(messages.groupBy(F.col("topic").alias("_topic")).agg(F.max("id").alias("_id")))
    newest = broadcast_counted(newest)
    found = messages.join(newest, F.col("topic").eqNullSafe(F.col("_topic")) & (F.col("id") == F.col("_id")))
    # copies of one message are all that is left of a topic
    return found.groupBy("topic", "id").agg(F.array_max(F.collect_set("payload")).alias("payload")).select("topic", "payload", "id")


def import_time(text: Column) -> Column:
    """Database date text to a time; the zero date is a missing date."""
    return F.nullif(text, F.lit(ZERO_DATE)).try_cast("timestamp_ntz")


def import_decimal(text: Column, precision: int = 18, scale: int = 2) -> Column:
    return text.try_cast(f"decimal({precision},{scale})")


def import_dump(spark: SparkSession, path: str, columns: str, times: Sequence[str], decimals: Sequence[str]) -> DataFrame:
    """A delimited database dump, every column read as text and cast by rule."""
    raw = spark.read.schema(columns).csv(path, header=True, nullValue="\\N")
    return cast_dump(raw, times, decimals)


def cast_dump(raw: DataFrame, times: Sequence[str], decimals: Sequence[str]) -> DataFrame:
    casts = {name: import_time(F.col(name)) for name in times}
    casts.update({name: import_decimal(F.col(name)) for name in decimals})
    return raw.withColumns(casts)
