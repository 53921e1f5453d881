"""Roll-ups that are kept up: partial states per load, merged, and chosen by request.

A roll-up stores the states of additive measures per combination of its dimensions. A
refresh reads only the facts of loads it does not have yet, and merges their states with
those of earlier refreshes that are not much larger, so few states are written again. A
request is answered from the smallest roll-up that holds its measures, dimensions and
filters, together with the facts that came since; if none does, from the facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.functions import timeparts
from sensorstar.plans.segments import kept_and_merged
from sensorstar.plans.semantic import Cube, Filter
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import literal_rows

STATE_SCHEMA = "name string, version int, upto int"
MANIFEST_SCHEMA = "segment int, rows long"


@dataclass(frozen=True)
class Rollup:
    name: str
    measures: tuple[str, ...]
    dimensions: tuple[str, ...]


@dataclass(frozen=True)
class Kept:
    """What a roll-up holds: the loads below ``upto``, in segments with so many rows."""

    version: int = 0
    upto: int = 0
    segments: tuple[tuple[int, int], ...] = ()

    def rows(self) -> int:
        return sum(rows for _, rows in self.segments)


class RollupStore:
    """Roll-ups of a warehouse's cube under ``root``. One writer at a time; a refresh that
    dies leaves the versions before it, and is repeated over the same folders."""

    def __init__(self, warehouse: Warehouse, cube: Cube, root: str, rollups: Sequence[Rollup]):
        self.warehouse, self.cube, self.root = warehouse, cube, root
        self.spark = warehouse.spark
        self.rollups = {r.name: r for r in rollups}
        for rollup in rollups:
            cube.check_additive(rollup.measures)

    def create(self) -> "RollupStore":
        literal_rows(self.spark, STATE_SCHEMA, []).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state")
        return self

    def kept(self) -> dict[str, Kept]:
        """The newest version of each roll-up."""
        rows = self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state")
        newest = rows.groupBy("name").agg(F.max("version"), F.max("upto")).collect()
        found = {name: Kept(version, upto, self._manifest(name, version)) for name, version, upto in newest}
        return {name: found.get(name, Kept()) for name in self.rollups}

    def _folder(self, name: str, segment: int) -> str:
        return f"{self.root}/{name}/segment={segment}"

    def _manifest(self, name: str, version: int) -> tuple[tuple[int, int], ...]:
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/{name}/version={version}").collect()
        return tuple(sorted((segment, count) for segment, count in rows))

    def _stored(self, rollup: Rollup, segments: Sequence[int]) -> DataFrame | None:
        if not segments:
            return None
        return self.spark.read.parquet(*[self._folder(rollup.name, n) for n in segments])

    def _fresh(self, rollup: Rollup, low: int, through: int) -> DataFrame:
        """States of the facts of some loads only."""
        newer = replace(self.cube, fact=lambda: self.warehouse.facts(through, low))
        return newer.states(rollup.measures, rollup.dimensions)

    def refresh(self) -> dict[str, int]:
        """Bring every roll-up up to the finished loads; states written per roll-up."""
        written, through = {}, self.warehouse.loads()
        for name, kept in self.kept().items():
            if kept.upto >= through:
                continue
            rollup, version = self.rollups[name], kept.version + 1
            path = self._folder(name, version)
            self._fresh(rollup, kept.upto, through).write.mode("overwrite").parquet(f"{path}-new")
            new = self.spark.read.parquet(f"{path}-new")
            staying, merged = kept_and_merged(list(kept.segments), new.count())
            older = self._stored(rollup, merged)
            states = new if older is None else self.cube.merged(older.unionByName(new), rollup.measures, rollup.dimensions)
            states.write.mode("overwrite").parquet(path)
            written[name] = self.spark.read.parquet(path).count()
            manifest = [*staying, (version, written[name])]
            target = f"{self.root}/{name}/version={version}"
            literal_rows(self.spark, MANIFEST_SCHEMA, manifest).coalesce(1).write.mode("overwrite").parquet(target)
            state = literal_rows(self.spark, STATE_SCHEMA, [(name, version, through)]).coalesce(1)
            state.write.mode("append").parquet(f"{self.root}/state")
        return written

    def choose(self, measures: Sequence[str], dimensions: Sequence[str], filters: Sequence[Filter] = ()) -> str | None:
        """The roll-up with the fewest rows that can answer a request."""
        needed = {*dimensions, *[f.member for f in filters]}
        kept = self.kept()
        able = [
            r.name
            for r in self.rollups.values()
            if kept[r.name].version and needed <= set(r.dimensions) and set(measures) <= set(r.measures)
        ]
        ignoring = any(f.member in self.cube.measures[m].ignores for m in measures for f in filters)
        return None if ignoring else min(able, key=lambda name: (kept[name].rows(), name), default=None)

    def query(
        self, measures: Sequence[str], dimensions: Sequence[str] = (), filters: Sequence[Filter] = (), grain: str | None = None
    ) -> DataFrame:
        """The same as the cube's answer, whatever the roll-ups hold by now."""
        name = self.choose(measures, dimensions, filters)
        if name is None:
            return self.cube.query(measures, dimensions, filters, grain)
        rollup, kept, through = self.rollups[name], self.kept()[name], self.warehouse.loads()
        states = self._stored(rollup, [n for n, _ in kept.segments])
        if kept.upto < through:
            states = states.unionByName(self._fresh(rollup, kept.upto, through))
        for f in filters:
            states = states.where(f.condition(F.col(f.member)))
        if grain and "full_date" in dimensions:
            states = states.withColumn("full_date", timeparts.truncated(F.col("full_date"), grain))
        return self.cube.finished(states, measures, dimensions)
