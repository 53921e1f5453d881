"""The dynamic staging: one table per group of topics, its columns found in the messages.

A load flattens the new messages of all groups in one scan and finds new columns and
their types in one aggregation. Then each group is loaded by itself: its rows and the
columns it gained are written to folders of their own and become visible with one control
row. A group that fails keeps its mark, leaves the others loaded, and is tried again by
the next load, over the same folders.

Rows are never rewritten when a table gains a column: files of earlier loads lack it, and
read as NULL. A column keeps the type of the value seen first. A value that does not fit
its column becomes NULL there and is stored beside the row as a reject.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorstar.functions import payload as P
from sensorstar.operators import control, discovery, flatten, grouping
from sensorstar.session import literal_rows, pinned, removed

BASE_SCHEMA = "landing_id long, original_time timestamp_ntz, topic string, load_dttm timestamp"
BASE_COLUMNS = [part.split()[0] for part in BASE_SCHEMA.split(", ")]
REJECT_SCHEMA = "rejected array<struct<path:string, type:string, text:string>>"
COLUMN_SCHEMA = "path string, type string, first_seen_id long"
STATE_SCHEMA = "group_id string, loads int, last_id long, at timestamp"
JOB_NAME = "load_dynamic_staging"
# Columns a table takes at most; the columns of one table come to the driver.
WIDEST = 1600
GROUP_NAME = re.compile(r"[A-Za-z0-9_]+")
SUCCESS, EMPTY, ERROR, INTERRUPTED = "SUCCESS", "EMPTY", "ERROR", "INTERRUPTED"


@dataclass(frozen=True)
class GroupResult:
    group_id: str
    status: str
    rows: int = 0
    columns_added: int = 0
    message: str | None = None


class TooWide(RuntimeError):
    """A group's messages have more paths than a table takes columns."""


def stored_name(path: str) -> str:
    """The column of a path. One that is named like a column every table has gets a
    name no path can have: runs of other signs are single in names made of paths."""
    return f"payload__{path}" if path in BASE_COLUMNS else path


def misfits(types: dict[str, str]) -> Column:
    """Values of ``_map`` that the typed columns beside it do not hold, with the type. A
    column that is filled had a value that fits, so only empty ones look for theirs."""

    def entry(path: str, kind: str) -> Column:
        shown = P.text_of(F.try_element_at("_map", F.lit(path)))
        found = F.struct(F.lit(path).alias("path"), F.lit(kind).alias("type"), shown.alias("text"))
        return F.when(F.col(f"`{stored_name(path)}`").isNull() & shown.isNotNull(), found)

    entries = [entry(path, kind) for path, kind in sorted(types.items()) if kind in discovery.CHECKED_TYPES]
    if not entries:
        return F.array().cast(REJECT_SCHEMA.split(" ", 1)[1])
    return F.filter(F.array(*entries), lambda found: found.isNotNull())


class DynamicStaging:
    """Tables under ``root``, a folder all executors share. One writer at a time.

    ``groups`` has ``(group_id, topic)``; names of groups are letters, digits and ``_``.
    """

    def __init__(self, spark: SparkSession, root: str, groups: DataFrame, widest: int = WIDEST):
        self.spark, self.root, self.groups, self.widest = spark, root, groups, widest
        self.names = sorted(row[0] for row in groups.select("group_id").distinct().collect())
        bad = [name for name in self.names if not GROUP_NAME.fullmatch(name)]
        if bad:
            raise ValueError(f"groups with other signs than letters, digits and _: {bad}")

    def create(self) -> "DynamicStaging":
        """No tables yet."""
        for table, schema in (("state", STATE_SCHEMA), ("runs", control.RUN_SCHEMA)):
            literal_rows(self.spark, schema, []).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{table}")
        return self

    # ---- reading ------------------------------------------------------------

    def state(self) -> dict[str, tuple[int, int]]:
        """Finished loads and the last loaded id of each group that has any."""
        rows = self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state")
        newest = rows.groupBy("group_id").agg(F.max("loads"), F.max("last_id")).collect()
        return {group: (loads, last_id) for group, loads, last_id in newest}

    def loads(self, group: str) -> int:
        return self.state().get(group, (0, 0))[0]

    def _folder(self, table: str, group: str) -> str:
        return f"{self.root}/{table}/group_id={group}"

    def _read(self, table: str, group: str, schema: str, loads: int) -> DataFrame:
        if not loads:
            return literal_rows(self.spark, "load int", []).select(
                *[F.lit(None).cast(field.dataType).alias(field.name) for field in StructType.fromDDL(schema)], "load"
            )
        rows = self.spark.read.schema(f"{schema}, load int").parquet(self._folder(table, group))
        return rows.where(F.col("load") < loads)

    def catalogue(self) -> DataFrame:
        """``(group_id, path, type, first_seen_id, load)``: every column, and the load
        that added it."""
        found = literal_rows(self.spark, f"group_id string, {COLUMN_SCHEMA}, load int", [])
        for group, (loads, _) in sorted(self.state().items()):
            columns = self._read("columns", group, COLUMN_SCHEMA, loads)
            found = found.unionByName(columns.withColumn("group_id", F.lit(group)))
        return found

    def columns(self, group: str, loads: int | None = None) -> dict[str, str]:
        """Paths and types of one table, as of now or of an earlier number of loads."""
        loads = self.loads(group) if loads is None else loads
        return discovery.column_types(self._read("columns", group, COLUMN_SCHEMA, loads))

    def _schema(self, group: str, loads: int) -> tuple[str, list[str]]:
        columns = sorted(self.columns(group, loads).items())
        typed = [f"`{stored_name(path)}` {discovery.SPARK_TYPES[kind]}" for path, kind in columns]
        return ", ".join([BASE_SCHEMA, REJECT_SCHEMA, *typed]), [stored_name(path) for path, _ in columns]

    def table(self, group: str, loads: int | None = None) -> DataFrame:
        """The rows of a group, a column for every path seen so far; or as they were
        after an earlier number of loads."""
        loads = self.loads(group) if loads is None else loads
        schema, names = self._schema(group, loads)
        return self._read("rows", group, schema, loads).select(*BASE_COLUMNS, *[f"`{name}`" for name in names])

    def rejects(self, group: str) -> DataFrame:
        """``(landing_id, topic, path, type, text)``: values that did not fit their column."""
        rows = self._read("rows", group, f"{BASE_SCHEMA}, {REJECT_SCHEMA}", self.loads(group))
        return rows.select("landing_id", "topic", F.explode("rejected").alias("_r")).select("landing_id", "topic", "_r.*")

    def run_events(self) -> DataFrame:
        return self.spark.read.schema(control.RUN_SCHEMA).parquet(f"{self.root}/runs")

    # ---- loading ------------------------------------------------------------

    def load(self, landing: DataFrame, up_to_id: int | None = None, stop: Callable[[], bool] = lambda: False) -> list[GroupResult]:
        """Load what came for each group since its last load, all or up to an id, in the
        order of their names. ``stop`` is asked before each group; a load that is stopped
        or interrupted ends with the group it would have loaded, the next one goes on there."""
        state = self.state()
        arrived = f"{self.root}/incoming/{uuid.uuid4().hex}"
        try:
            rows = self._flattened(landing, state, up_to_id, f"{arrived}/rows")
            found = pinned(discovery.catalogue(flatten.leaf_rows(rows, "id", "group_id"), "group_id"))
            counted = rows.groupBy("group_id").agg(F.count("*"), F.max("id")).collect()
            news = {group: (count, last_id) for group, count, last_id in counted}
            results = []
            for group in self.names:
                count, last_id = news.get(group, (0, 0))
                result = self._attempt(rows, found, group, state.get(group, (0, 0))[0], count, last_id, stop)
                self._log(result)
                results.append(result)
                if result.status == INTERRUPTED:
                    break
            return results
        finally:
            removed(self.spark, arrived)

    def _flattened(self, landing: DataFrame, state: dict, up_to_id: int | None, path: str) -> DataFrame:
        """New messages of all groups with their leaves, written once, by group."""
        marks = literal_rows(self.spark, "group_id string, last_id long", [(g, last_id) for g, (_, last_id) in state.items()])
        messages = grouping.in_groups(landing, self.groups).join(F.broadcast(marks), "group_id", "left")
        messages = messages.where(F.col("id") > F.coalesce("last_id", F.lit(0))).drop("last_id")
        if up_to_id is not None:
            messages = messages.where(F.col("id") <= up_to_id)
        rows = flatten.flattened(messages).select("group_id", "id", "time", "topic", "leaves")
        rows.write.partitionBy("group_id").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _attempt(self, rows, found, group: str, load: int, count: int, last_id: int, stop) -> GroupResult:
        try:
            if stop():
                return GroupResult(group, INTERRUPTED)
            if not count:
                return GroupResult(group, EMPTY)
            added = self._write(rows, found, group, load)
            state = [(group, load + 1, last_id, dt.datetime.now(dt.timezone.utc))]
            literal_rows(self.spark, STATE_SCHEMA, state).coalesce(1).write.mode("append").parquet(f"{self.root}/state")
            return GroupResult(group, SUCCESS, count, added)
        except KeyboardInterrupt:
            return GroupResult(group, INTERRUPTED)
        except Exception as error:  # noqa: BLE001  one group's failure is its own
            return GroupResult(group, ERROR, message=str(error))

    def _write(self, rows: DataFrame, found: DataFrame, group: str, load: int) -> int:
        """The columns a group gained, and its rows. Nothing is visible yet."""
        known = self._read("columns", group, COLUMN_SCHEMA, load)
        fresh = discovery.added_columns(found.where(F.col("group_id") == group).drop("group_id"), known, "path")
        fresh = pinned(fresh.select("path", "type", "first_seen_id"))
        columns = known.drop("load").unionByName(fresh)
        width = columns.count()
        if width > self.widest:
            raise TooWide(f"{width} columns, a table takes {self.widest}")
        fresh.coalesce(1).write.mode("overwrite").parquet(f"{self._folder('columns', group)}/load={load}")
        types = discovery.column_types(columns)
        mine = rows.where(F.col("group_id") == group)
        mine = mine.select(
            F.col("id").alias("landing_id"),
            F.col("time").alias("original_time"),
            "topic",
            F.current_timestamp().alias("load_dttm"),
            "leaves",
        )
        names = [f"`{stored_name(path)}`" for path in sorted(types)]
        wide = discovery.wide(mine, [*BASE_COLUMNS, "_map"], types, stored_name)
        wide = wide.select(*BASE_COLUMNS, misfits(types).alias("rejected"), *names)
        wide.write.mode("overwrite").parquet(f"{self._folder('rows', group)}/load={load}")
        return fresh.count()

    def _log(self, result: GroupResult) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        event = [(str(uuid.uuid4()), JOB_NAME, result.group_id, result.status, now, result.rows, 0, result.message)]
        literal_rows(self.spark, control.RUN_SCHEMA, event).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

