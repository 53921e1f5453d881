"""Segments: what compaction makes of the folders that loads leave behind.

Each load writes a folder of its own. Compaction merges the rows of new loads, part by part
(a part is a week of facts or the members of a dimension), sorts them over the whole part
and writes them as one segment. It takes older segments of the part along as long as they
are not much larger than what they are merged with, so a part has few segments, a row is
rewritten a few times only, and a large old part is left alone by a few late rows.

A manifest names the segments. The control row that names the manifest makes them visible
at once. Rows keep their load number, so earlier states are still answered. Folders that
are no longer named stay until they are vacuumed: whoever reads them is not disturbed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.session import folders, literal_rows, removed

MANIFEST_SCHEMA = "part string, segment int, rows long, upto int"
# A segment is merged with newer rows that are at least this share of it.
MERGE_RATIO = 4
# How Spark names the folder of a part without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Table:
    """A table in folders: its columns, the column that makes parts, and its sort order."""

    name: str
    schema: str
    part: str | None
    order: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    """The segments of each part, oldest first, with their rows; they hold the loads below
    ``upto``."""

    number: int
    upto: int
    segments: dict[str, list[tuple[int, int]]]

    def numbers(self) -> set[int]:
        return {number for found in self.segments.values() for number, _ in found}


def kept_and_merged(segments: list[tuple[int, int]], rows: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Segments that stay, and the newest ones that ``rows`` new rows are merged with."""
    kept, merged = list(segments), []
    while kept and kept[-1][1] <= MERGE_RATIO * rows:
        number, more = kept.pop()
        merged.append(number)
        rows += more
    return kept, merged


class SegmentStore:
    """The segments of the tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def folder(self, table: Table, number: int, part: str | None = None) -> str:
        whole = f"{self.root}/{table.name}_segments/segment={number}"
        return f"{whole}/{table.part}={part}" if table.part and part is not None else whole

    def manifest(self, table: Table, number: int, first_load: int) -> Manifest:
        """Manifest ``number`` of a table; number 0 is the state before any compaction."""
        if not number:
            return Manifest(0, first_load, {})
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/manifests/{table.name}/{number}").collect()
        segments: dict[str, list[tuple[int, int]]] = {}
        for part, segment, count, _ in sorted(rows, key=lambda r: r[1]):
            if segment:
                segments.setdefault(part, []).append((segment, count))
        return Manifest(number, max(r[3] for r in rows), segments)

    def read(self, table: Table, manifest: Manifest, part: str | None = None) -> DataFrame | None:
        """The rows of all segments, or of one part, with their ``load``."""
        parts = manifest.segments if part is None else {p: s for p, s in manifest.segments.items() if p == part}
        return self._read(table, sorted({self.folder(table, n, p) for p, found in parts.items() for n, _ in found}))

    def _read(self, table: Table, paths: list[str]) -> DataFrame | None:
        if not paths:
            return None
        base = f"{self.root}/{table.name}_segments"
        rows = self.spark.read.schema(f"{table.schema}, load int, segment int").option("basePath", base)
        return rows.parquet(*paths).drop("segment")

    def compact(self, table: Table, manifest: Manifest, fresh: DataFrame, upto: int) -> Manifest:
        """Merge ``fresh`` rows, with their ``load``, into the segments. Written, not yet named
        by a control row; a compaction that dies is simply repeated."""
        number = manifest.number + 1
        value = F.coalesce(F.col(table.part).cast("string"), F.lit(NO_VALUE)) if table.part else F.lit("")
        counts = dict(fresh.groupBy(value).count().collect())
        segments, paths = dict(manifest.segments), []
        for part, rows in counts.items():
            kept, merged = kept_and_merged(segments.get(part, []), rows)
            paths += [self.folder(table, n, part) for n in merged]
            segments[part] = kept
        if counts:
            older = self._read(table, sorted(paths))
            rows = fresh if older is None else older.unionByName(fresh)
            order = [*([table.part] if table.part else []), *table.order]
            writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
            path = self.folder(table, number)
            (writer.partitionBy(table.part) if table.part else writer).parquet(path)
            written = dict(self._read(table, [path]).groupBy(value).count().collect())
            for part, found in written.items():
                segments[part] = [*segments[part], (number, found)]
        entries = [(part, n, rows, upto) for part, found in segments.items() for n, rows in found]
        entries = entries or [("", 0, 0, upto)]
        target = f"{self.root}/manifests/{table.name}/{number}"
        literal_rows(self.spark, MANIFEST_SCHEMA, entries).coalesce(1).write.mode("overwrite").parquet(target)
        return Manifest(number, upto, segments)

    def vacuum(self, table: Table, manifests: list[Manifest]) -> int:
        """Delete the folders of loads and the parts of segments that none of these
        manifests needs; the number of folders deleted."""
        first_needed = min(m.upto for m in manifests)
        gone = [f for f in folders(self.spark, f"{self.root}/{table.name}/load=*") if int(f.rpartition("=")[2]) < first_needed]
        needed = {self.folder(table, n, p if table.part else None) for m in manifests for p, found in m.segments.items() for n, _ in found}
        inner = f"/{table.part}=*" if table.part else ""
        stored = folders(self.spark, f"{self.root}/{table.name}_segments/segment=*{inner}")
        gone += [f for f in stored if not any(f.endswith(path.removeprefix(self.root)) for path in needed)]
        for folder in gone:
            removed(self.spark, folder)
        return len(gone)
