"""Incremental control: high-water marks, run log, batch progress.

Marks and runs are append-only tables. The current state of a key is its newest
row, so a writer never rewrites a file that a reader has open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.operators.numbering import running_totals

CONTROL_SCHEMA = (
    "topic string, process_step int, last_loaded_id long, full_load_done boolean, last_update timestamp"
)
RUN_SCHEMA = (
    "run_id string, job_name string, topic string, status string, event_time timestamp, "
    "rows_inserted long, rows_updated long, error_message string"
)
STAGE_STEP = 1
FACT_STEP = 2


def high_water_mark(control: DataFrame, topic: str, step: int = STAGE_STEP) -> DataFrame:
    """The last loaded id of a topic (or LIKE pattern of topics), 0 before the first load."""
    return control.where((F.col("topic") == topic) & (F.col("process_step") == step)).agg(
        F.coalesce(F.max("last_loaded_id"), F.lit(0)).alias("last_loaded_id")
    )


def high_water_marks_like(control: DataFrame, pattern: str) -> DataFrame:
    return control.where(F.col("topic").like(pattern)).agg(
        F.coalesce(F.max("last_loaded_id"), F.lit(0)).alias("last_loaded_id")
    )


def _newest(marks: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The newest mark of every key. Marks are narrow; copies collapse in each task first."""
    rest = [c for c in marks.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return marks.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*marks.columns)


def guarded_upsert(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """A mark only ever moves forward."""
    return _newest(current.unionByName(incoming), ["topic"], ["last_loaded_id", "last_update"])


def plain_upsert(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The newest update wins, also when its mark is lower."""
    return _newest(current.unionByName(incoming), ["topic"], ["last_update", "last_loaded_id"])


def append_upsert(history: DataFrame) -> DataFrame:
    """Current marks of an append-only control table."""
    return _newest(history, ["topic", "process_step"], ["last_update", "last_loaded_id"])


def resume_range(staging: DataFrame, mark: int, limit: int) -> DataFrame:
    """The next ids to load: after the mark, at most ``limit`` of the id range.

    Without a mark the range starts at the lowest staged id. The last id loaded
    before is not loaded again.
    """
    bounds = staging.agg(F.min("landing_id").alias("low"), F.max("landing_id").alias("high"))
    first = F.lit(mark + 1) if mark else F.coalesce("low", F.lit(1))
    return bounds.select(
        first.cast("long").alias("first_id"),
        F.when(F.col("high") < first + limit - 1, F.col("high")).otherwise(first + limit - 1).cast("long").alias("last_id"),
        F.coalesce(F.col("high") >= first, F.lit(False)).alias("has_rows"),
    )


def runs(events: DataFrame) -> DataFrame:
    """One row per run: its newest status, its first and its last event time."""
    newest = F.max_by(
        F.struct("job_name", "topic", "status", "rows_inserted", "rows_updated", "error_message"), "event_time"
    )
    ended = F.max(F.when(F.col("status") != "RUNNING", F.col("event_time")))
    return (
        events.groupBy("run_id")
        .agg(newest.alias("_last"), F.min("event_time").alias("start_time"), ended.alias("end_time"))
        .select("run_id", "_last.*", "start_time", "end_time")
    )


def progress(batches: DataFrame) -> DataFrame:
    """Throughput per batch: rows per second so far, share done, seconds left.

    ``batches`` has ``job, batch_no, rows, seconds``.
    """
    amounts = {"rows": "rows_so_far", "seconds": "seconds_so_far"}
    both = running_totals(batches.select("job", "batch_no", "rows", "seconds"), ["job"], ["batch_no"], amounts, {"rows": "_total"})
    rate = F.col("rows_so_far") / F.col("seconds_so_far")
    return both.select(
        "job",
        "batch_no",
        "rows",
        "rows_so_far",
        F.round(rate, 4).alias("rows_per_second"),
        F.round(F.col("rows_so_far") * 100 / F.col("_total"), 4).alias("percent_done"),
        F.round((F.col("_total") - F.col("rows_so_far")) / rate, 4).alias("seconds_left"),
    )
