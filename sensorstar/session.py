"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import datetime as dt
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "sensorstar", **conf: str) -> SparkSession:
    """A session with the settings every job here expects."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that can be changed on a session somebody else built.

    A repeated key in a JSON object keeps its last value, as in a dictionary.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="sensorstar-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern; none is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or [] if status.isDirectory()]


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder: later reads see the same rows in
    the same partitions, also after an executor is lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


# Rows of costly work that one task takes at most, about.
TASK_ROWS = 200_000


def split_rows(df: DataFrame) -> tuple[int, int, int]:
    """Splits that hold rows, rows of all splits and of the largest one. Few columns are read."""
    splits = df.groupBy(F.spark_partition_id().alias("_split")).agg(F.count("*").alias("_rows"))
    filled, rows, most = splits.agg(F.count("*"), F.sum("_rows"), F.max("_rows")).first()
    return filled, rows or 0, most or 0


def spread(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows dealt out in tasks of bounded size, one a core at least: costly work on each row
    should not wait for one task. Splits do not tell: of all splits of a file that is one
    row group, one holds the rows. A table whose splits are many and small stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    filled, rows, most = split_rows(df)
    if filled >= cores and most <= 2 * task_rows:
        return df
    return df.repartition(max(cores, -(-rows // task_rows)))


def bounded(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The same for cheaper work: a table of few rows is not dealt out to more tasks."""
    _, rows, most = split_rows(df)
    return df if most <= 2 * task_rows else df.repartition(-(-rows // task_rows))


def literal(value: object) -> Column:
    """A literal; a time without a zone stays without one in any session."""
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def literal_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few rows known to the driver, as SQL literals: no Python worker starts."""
    fields = [part.split() for part in schema.split(", ")]
    columns = [F.lit(None).cast(kind).alias(name) for name, kind in fields]
    empty = spark.range(1).select(*columns)
    if not rows:
        return empty.where(F.lit(False))
    structs = [
        F.struct(*[literal(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


# A table of at most this many narrow rows fits in every executor.
BROADCAST_ROWS = 4_000_000


def broadcast_up_to(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``limit`` rows; beyond
    that the planner shuffles both sides of the join."""
    return F.broadcast(df) if rows <= limit else df


def broadcast_counted(df: DataFrame) -> DataFrame:
    """The same for a table whose rows have to be counted first."""
    return broadcast_up_to(df, df.count())
