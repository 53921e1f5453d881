"""Delimited hand-off files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def write_handoff(df: DataFrame, path: str) -> None:
    """Comma-separated files in which a missing value is ``\\N``.

    An empty text is written as ``""`` and so stays distinct from a missing one.
    Backslashes and line breaks in texts are doubled and spelled out: a row is one
    line, files can be split, and a text like the mark is no missing value.
    """
    options = {"nullValue": NULL_MARK, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.select(_texts(df, _escaped)).write.mode("overwrite").options(**options, escape='"').csv(path)


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> list[Column]:
    return [change(F.col(c)).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes]


def _escaped(text: Column) -> Column:
    for sign, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(sign), F.lit(shown))
    return text


def _unescaped(text: Column) -> Column:
    def plain(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def read_handoff(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = spark.read.schema(schema).options(nullValue=NULL_MARK, escape='"').csv(path)
    return rows.select(_texts(rows, _unescaped))


def append_batch(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("append").partitionBy(*partitions).parquet(path)


def write_group_report(report: DataFrame, path: str) -> None:
    """``GroupID;NumTopics;Topics;Keys``, the largest group first."""
    (
        report.select(
            F.col("group_id").alias("GroupID"),
            F.col("num_topics").alias("NumTopics"),
            F.col("topics").alias("Topics"),
            F.col("keys").alias("Keys"),
        )
        .orderBy(F.desc("NumTopics"), "GroupID")
        .write.mode("overwrite")
        .option("sep", ";")
        .option("header", True)
        .csv(path)
    )
