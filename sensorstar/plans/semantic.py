"""Named measures and dimensions over the star, answered by one function.

A query first groups the facts by the keys it needs and only then joins the
dimensions: the join sees one row per key combination, not one per fact, and a
large dimension such as the calendar never meets the whole fact table. Only the
dimensions a query names are joined.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.functions import timeparts
from sensorstar.operators.dimensions import DIMENSION_COLUMNS
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import broadcast_up_to, literal


@dataclass(frozen=True)
class Measure:
    """``type`` is count, sum, avg, min, max, distinct or distinct_with_blank;
    ``sql`` is its value on a fact row. Filters on a member in ``ignores`` do
    not reach it."""

    name: str
    type: str
    sql: str = "1"
    title: str = ""
    ignores: tuple[str, ...] = ()


@dataclass(frozen=True)
class Dimension:
    """``table`` is the dimension table, or None for a column of the fact.
    ``unique`` says that no two keys of the table share a value."""

    name: str
    sql: str
    table: str | None = None
    title: str = ""
    hidden: bool = False
    sort_by: str | None = None
    unique: bool = False


@dataclass(frozen=True)
class Join:
    fact_key: str
    dimension_key: str
    as_text: bool = False


@dataclass(frozen=True)
class Filter:
    """``op`` is equals, not_equals, in, gt, gte, lt, lte, set or not_set."""

    member: str
    op: str
    value: object = None

    def condition(self, column: Column) -> Column:
        tests: dict[str, Callable[[], Column]] = {
            "equals": lambda: column == literal(self.value),
            "not_equals": lambda: column != literal(self.value),
            "in": lambda: column.isin(*[literal(v) for v in self.value]),
            "gt": lambda: column > literal(self.value),
            "gte": lambda: column >= literal(self.value),
            "lt": lambda: column < literal(self.value),
            "lte": lambda: column <= literal(self.value),
            "set": column.isNotNull,
            "not_set": column.isNull,
        }
        return tests[self.op]()


def month_name_sql(column: str) -> str:
    branches = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(timeparts.CZECH_MONTHS, 1))
    return f"CASE {column} {branches} END"


@dataclass
class Cube:
    fact: Callable[[], DataFrame]
    tables: Mapping[str, Callable[[], DataFrame]] = field(default_factory=dict)
    joins: Mapping[str, Join] = field(default_factory=dict)
    measures: Mapping[str, Measure] = field(default_factory=dict)
    dimensions: Mapping[str, Dimension] = field(default_factory=dict)
    hierarchies: Mapping[str, Sequence[str]] = field(default_factory=dict)
    # Rows of a table where they are known without counting.
    known_rows: Mapping[str, int] = field(default_factory=dict)

    # ---- queries --------------------------------------------------------------

    def query(
        self,
        measures: Sequence[str],
        dimensions: Sequence[str] = (),
        filters: Sequence[Filter] = (),
        grain: str | None = None,
        order: Sequence[Column] = (),
        limit: int | None = None,
        how: str = "left",
    ) -> DataFrame:
        """Measures per combination of dimension values.

        ``grain`` cuts the time dimension ``full_date`` to minute … year.
        """
        states = self._states(measures, dimensions, filters)
        labelled = self._labelled(states, dimensions, grain, how)
        if how == "inner" and self._one_row_per_group(measures, dimensions, grain):
            found = labelled.select(*dimensions, *[self._from_one_state(self.measures[m]) for m in measures])
        else:
            found = self._finish(labelled, measures, dimensions)
        if order:
            found = found.orderBy(*order)
        return found if limit is None else found.limit(limit)

    def rollup(self, measures: Sequence[str], hierarchy: str, filters: Sequence[Filter] = ()) -> DataFrame:
        """Measures on every level of a hierarchy; ``level`` counts the levels
        that are rolled up (0 = the finest)."""
        levels = list(self.hierarchies[hierarchy])
        labelled = self._labelled(self._states(measures, levels, filters), levels, None, "left")
        depth = F.length(F.replace(F.bin(F.grouping_id()), F.lit("0"), F.lit(""))).cast("int")
        wanted = [self.measures[m] for m in measures]
        rows = labelled.rollup(*levels).agg(depth.alias("level"), *[self._final(m) for m in wanted])
        return rows.select("level", *levels, *measures)

    def drill(self, hierarchy: str, path: Sequence[object], measures: Sequence[str]) -> DataFrame:
        """The level below ``path``, whose values fix the levels above it."""
        levels = self.hierarchies[hierarchy]
        filters = [Filter(level, "equals", value) for level, value in zip(levels, path)]
        return self.query(measures, [levels[len(path)]], filters)

    def details(self, members: Sequence[str], filters: Sequence[Filter] = ()) -> DataFrame:
        """The fact rows behind a group, with the named members."""
        rows = self._filtered(self.fact(), filters)
        for table in self._tables(members):
            rows = self._join(rows, table, members, "left", every_fact=True)
        columns = [F.expr(self.dimensions[m].sql).alias(m) if self.dimensions[m].table is None else F.col(m) for m in members]
        return rows.select(*columns)

    def view(self, members: Mapping[str, Sequence[str]], prefix: bool = True) -> DataFrame:
        """A flat slice: members per table, named ``table_member`` when prefixed."""
        names = [m for chosen in members.values() for m in chosen]
        hidden = [m for m in names if self.dimensions[m].hidden]
        if hidden:
            raise ValueError(f"hidden members cannot be shown: {', '.join(hidden)}")
        rows = self.details(names)
        if not prefix:
            return rows
        return rows.select(*[F.col(m).alias(f"{table}_{m}") for table, chosen in members.items() for m in chosen])

    def visible(self) -> list[str]:
        return [d.name for d in self.dimensions.values() if not d.hidden]

    # ---- stored roll-ups --------------------------------------------------------

    def check_additive(self, measures: Sequence[str]) -> None:
        kinds = {self.measures[m].type for m in measures}
        if any(kind.startswith("distinct") for kind in kinds):
            raise ValueError("distinct counts cannot be added up from a stored roll-up")

    def states(self, measures: Sequence[str], dimensions: Sequence[str]) -> DataFrame:
        """The states of additive measures per dimension combination."""
        self.check_additive(measures)
        return self.merged(self._labelled(self._states(measures, dimensions, ()), dimensions, None, "left"), measures, dimensions)

    def merged(self, states: DataFrame, measures: Sequence[str], dimensions: Sequence[str]) -> DataFrame:
        """States of equal dimension values as one."""
        merged = [_merge(state, how).alias(state) for m in measures for state, (_, how) in self._parts(self.measures[m])]
        return states.groupBy(*dimensions).agg(*merged)

    def finished(self, states: DataFrame, measures: Sequence[str], dimensions: Sequence[str]) -> DataFrame:
        """Measures from states, for any subset of their dimensions."""
        return self._finish(states, measures, dimensions)

    def build_rollup(self, measures: Sequence[str], dimensions: Sequence[str], path: str) -> None:
        """Store the states of additive measures per dimension combination."""
        self.states(measures, dimensions).write.mode("overwrite").parquet(path)

    def from_rollup(self, spark: SparkSession, path: str, measures: Sequence[str], dimensions: Sequence[str]) -> DataFrame:
        """Answer from a stored roll-up; any subset of its dimensions will do."""
        return self._finish(spark.read.parquet(path), measures, dimensions)

    def _one_row_per_group(self, measures: Sequence[str], dimensions: Sequence[str], grain: str | None) -> bool:
        """Whether key groups and value groups are the same, so that grouping by
        the values again would change nothing."""
        if not dimensions or any(self.measures[m].type.startswith("distinct") for m in measures):
            return False
        unique = {self.dimensions[m].table for m in dimensions if self.dimensions[m].unique and not (grain and m == "full_date")}
        return all(t in unique for t in self._tables(dimensions))

    def _from_one_state(self, m: Measure) -> Column:
        if m.type == "avg":
            return (F.col(f"_{m.name}_sum") / F.nullif(F.col(f"_{m.name}_count"), F.lit(0))).alias(m.name)
        return F.col(f"_{m.name}").alias(m.name)

    # ---- parts ------------------------------------------------------------------

    def _tables(self, members: Sequence[str]) -> list[str]:
        return list(dict.fromkeys(t for t in (self.dimensions[m].table for m in members) if t))

    def _sized(self, rows: DataFrame, table: str) -> DataFrame:
        """A side that meets every fact: broadcast when its rows are known to be
        few, else left to the planner, which goes by file size."""
        return broadcast_up_to(rows, self.known_rows[table]) if table in self.known_rows else rows

    def _join(
        self,
        rows: DataFrame,
        table: str,
        members: Sequence[str],
        how: str,
        grain: str | None = None,
        every_fact: bool = False,
    ) -> DataFrame:
        join = self.joins[table]
        chosen = [self.dimensions[m] for m in dict.fromkeys(members) if self.dimensions[m].table == table]
        labels = []
        for member in chosen:
            label = F.expr(member.sql)
            if grain and member.name == "full_date":
                label = timeparts.truncated(label, grain)
            labels.append(label.alias(member.name))
        right = self.tables[table]().select(F.col(join.dimension_key).alias("_key"), *labels)
        if join.as_text:
            same = F.col(join.fact_key).cast("string") == F.col("_key").cast("string")
        else:
            same = F.col(join.fact_key) == F.col("_key")
        return rows.join(self._sized(right, table) if every_fact else right, same, how).drop("_key")

    def _filtered(self, rows: DataFrame, filters: Sequence[Filter]) -> DataFrame:
        for f in filters:
            member = self.dimensions[f.member]
            if member.table is None:
                rows = rows.where(f.condition(F.expr(member.sql)))
        for table in self._tables([f.member for f in filters]):
            join = self.joins[table]
            kept = self.tables[table]()
            for f in filters:
                if self.dimensions[f.member].table == table:
                    kept = kept.where(f.condition(F.expr(self.dimensions[f.member].sql)))
            kept = self._sized(kept.select(F.col(join.dimension_key).alias("_key")), table)
            rows = rows.join(kept, F.col(join.fact_key) == F.col("_key"), "left_semi")
        return rows

    def _states(self, measures: Sequence[str], dimensions: Sequence[str], filters: Sequence[Filter]) -> DataFrame:
        """Partial aggregates per key combination (and per counted value)."""
        wanted = [self.measures[m] for m in measures]
        ignored = {name for m in wanted for name in m.ignores}
        rows = self._filtered(self.fact(), [f for f in filters if f.member not in ignored])
        within: dict[str, Column] = {}
        for m in wanted:
            for f in filters:
                if f.member in ignored and f.member not in m.ignores:
                    test = f.condition(F.expr(self.dimensions[f.member].sql))
                    within[m.name] = within[m.name] & test if m.name in within else test

        def value(m: Measure) -> Column:
            plain = F.expr(m.sql)
            return F.when(within[m.name], plain) if m.name in within else plain

        keys = {self.joins[t].fact_key: F.col(self.joins[t].fact_key) for t in self._tables(dimensions)}
        for name in dimensions:
            if self.dimensions[name].table is None:
                keys[name] = F.expr(self.dimensions[name].sql)
        for m in wanted:
            if m.type.startswith("distinct"):
                keys[f"_{m.name}_value"] = value(m)
            if m.type == "distinct_with_blank":
                blank = F.expr(m.sql).isNull()
                keys[f"_{m.name}_blank"] = within[m.name] & blank if m.name in within else blank
        aggregates = [
            _first_state(how, value(m)).alias(state) for m in wanted for state, (how, _) in self._parts(m)
        ]
        grouped = rows.groupBy(*[column.alias(name) for name, column in keys.items()])
        return grouped.agg(*aggregates) if aggregates else grouped.agg(F.count("*").alias("_rows"))

    def _parts(self, m: Measure) -> list[tuple[str, tuple[str, str]]]:
        if m.type == "avg":
            return [(f"_{m.name}_sum", ("sum", "sum")), (f"_{m.name}_count", ("count", "sum"))]
        if m.type.startswith("distinct"):
            return []
        return [(f"_{m.name}", (m.type, "sum" if m.type == "count" else m.type))]

    def _labelled(self, states: DataFrame, dimensions: Sequence[str], grain: str | None, how: str) -> DataFrame:
        for table in self._tables(dimensions):
            states = self._join(states, table, dimensions, how, grain)
        return states

    def _final(self, m: Measure) -> Column:
        if m.type == "avg":
            found = F.sum(f"_{m.name}_sum") / F.nullif(F.sum(f"_{m.name}_count"), F.lit(0))
        elif m.type == "count":
            found = F.coalesce(F.sum(f"_{m.name}"), F.lit(0))
        elif m.type == "distinct":
            found = F.count_distinct(F.col(f"_{m.name}_value"))
        elif m.type == "distinct_with_blank":
            value = F.col(f"_{m.name}_value")
            found = F.count_distinct(value) + F.coalesce(F.max(F.col(f"_{m.name}_blank").cast("int")), F.lit(0))
        else:
            found = _merge(f"_{m.name}", m.type)
        return found.alias(m.name)

    def _finish(self, labelled: DataFrame, measures: Sequence[str], dimensions: Sequence[str]) -> DataFrame:
        finals = [self._final(self.measures[m]) for m in measures]
        return labelled.groupBy(*dimensions).agg(*finals)


def _first_state(how: str, value: Column) -> Column:
    return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[how](value)


def _merge(state: str, how: str) -> Column:
    return {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}[how](state)


# ---- the camera cube ----------------------------------------------------------------

MOVING = "CASE WHEN velocity > 0 THEN velocity END"
KNOWN = "CASE WHEN velocity >= 0 THEN velocity END"

MEASURES = [
    Measure("detections", "count", title="Detections"),
    Measure("detection_count", "count", "camera_detection_key", "Detections by key"),
    Measure("detection_type_distinct", "distinct", "detection_type_key", "Detection types"),
    Measure("detections_with_velocity", "sum", "CASE WHEN velocity > 0 THEN 1 END", "Detections with velocity > 0, NULL if none"),
    Measure("detection_count_with_velocity", "count", "CASE WHEN velocity > 0 THEN 1 END", "Detections with velocity > 0"),
    Measure("avg_velocity", "avg", MOVING, "Average velocity (> 0)"),
    Measure("avg_velocity_known", "avg", KNOWN, "Average velocity (>= 0)"),
    Measure("avg_velocity_raw", "avg", "velocity", "Average velocity"),
    Measure("min_velocity", "min", "velocity", "Lowest velocity"),
    Measure("max_velocity", "max", "velocity", "Highest velocity"),
    Measure("max_velocity_known", "max", KNOWN, "Highest velocity (>= 0)"),
    Measure("sum_velocity_known", "sum", "CASE WHEN velocity >= 0 THEN velocity ELSE 0 END", "Sum of velocities (>= 0)"),
    Measure("sum_velocity", "sum", "velocity", "Sum of velocities"),
    # A plate has one key, so plates are counted by key without reading the plate table.
    Measure("unique_plates", "distinct", "lp_key", "Distinct plates"),
    Measure("distinct_velocity_count", "distinct", "velocity", "Distinct velocities"),
    Measure("velocity_distinct_with_blank", "distinct_with_blank", "velocity", "Distinct velocities, blank included"),
    Measure("velocity_count", "count", "velocity", "Rows with a velocity"),
    Measure("velocity_average_moving", "avg", MOVING, "Average velocity (> 0), whatever the velocity filter", ("velocity",)),
]

DIMENSIONS = [
    Dimension("id", "camera_detection_key"),
    Dimension("velocity", "velocity"),
    Dimension("week_bucket", "week_bucket"),
    Dimension("time_key_hidden", "time_key", hidden=True),
    Dimension("sensor_key_hidden", "sensor_key", hidden=True),
    Dimension("lp_key_hidden", "lp_key", hidden=True),
    Dimension("country_key_hidden", "country_key", hidden=True),
    Dimension("vehicle_class_key_hidden", "CAST(vehicle_class_key AS STRING)", hidden=True),
    Dimension("city_key_hidden", "city_key", hidden=True),
    Dimension("detection_type_key", "detection_type_key"),
    Dimension("city_name", "city_name", "city", unique=True),
    Dimension("is_active", "is_active", "city"),
    Dimension("country_code", "country_code", "country", unique=True),
    Dimension("sensor_code", "sensor_code", "sensor", unique=True),
    Dimension("vehicle_class", "vehicle_class", "vehicle_class", unique=True),
    Dimension("license_plate", "license_plate", "plate", unique=True),
    Dimension("detection_type", "detection_type", "detection_type", unique=True),
    Dimension("full_date", "full_date", "calendar", unique=True),
    Dimension("year", "year_num", "calendar"),
    Dimension("month", "month_num", "calendar"),
    Dimension("day", "day_num", "calendar"),
    Dimension("weekday", "day_of_week_num", "calendar"),
    Dimension("hour", "hour_num", "calendar"),
    Dimension("minute", "minute_num", "calendar"),
    Dimension("month_name", month_name_sql("month_num"), "calendar", sort_by="month"),
    Dimension("year_month_sort", "year_num * 100 + month_num", "calendar", hidden=True),
    Dimension(
        "month_year_merged",
        f"concat(year_num, '-', lpad(month_num, 2, '0'), ' ', {month_name_sql('month_num')})",
        "calendar",
    ),
    Dimension("month_name_english", "date_format(full_date, 'MMMM')", "calendar", sort_by="month"),
    Dimension("month_year_english", "date_format(full_date, 'MMMM yyyy')", "calendar", sort_by="year_month_sort"),
]

HIERARCHIES = {
    "date": ("year", "month", "day", "full_date"),
    "time": ("hour", "minute"),
}


def camera_cube(warehouse: Warehouse) -> Cube:
    tables: dict[str, Callable[[], DataFrame]] = {
        name: (lambda n=name: warehouse.dimension(n)) for name in DIMENSION_COLUMNS
    }
    tables["calendar"] = warehouse.calendar
    joins = {name: Join(key, key) for name, (key, _) in DIMENSION_COLUMNS.items()}
    joins["calendar"] = Join("time_key", "time_key")
    joins["detection_type"] = Join("detection_type_key", "detection_type_key", as_text=True)
    return Cube(
        fact=warehouse.facts,
        tables=tables,
        joins=joins,
        measures={m.name: m for m in MEASURES},
        dimensions={d.name: d for d in DIMENSIONS},
        hierarchies=HIERARCHIES,
        known_rows={"calendar": warehouse.calendar_rows()},
    )


def monitor_cube(rows: Callable[[], DataFrame], members: Sequence[str]) -> Cube:
    """Row counts of an operational table by any of its columns."""
    return Cube(
        fact=rows,
        measures={"count": Measure("count", "count")},
        dimensions={m: Dimension(m, m) for m in members},
    )


# The members the monitoring cubes show.
RUN_MEMBERS = ("job_name", "topic", "status", "error_message", "start_time", "end_time")
CONTROL_MEMBERS = ("topic", "last_update")
STAGING_MEMBERS = ("city", "detection_type", "lp", "sensor", "ilpc", "load_dttm", "original_time", "utc")


def between(start: dt.datetime, end: dt.datetime) -> list[Filter]:
    """Times from ``start`` to before ``end``; whole weeks outside are not read."""
    monday = start.date() - dt.timedelta(days=start.weekday())
    return [
        Filter("week_bucket", "gte", monday),
        Filter("week_bucket", "lt", end.date() + dt.timedelta(days=1)),
        Filter("full_date", "gte", start),
        Filter("full_date", "lt", end),
    ]


def table_partition(warehouse: Warehouse, table: str) -> DataFrame:
    """The whole of one model table, as the model imports it."""
    if table == "facts":
        return warehouse.facts()
    return warehouse.calendar() if table == "calendar" else warehouse.dimension(table)
