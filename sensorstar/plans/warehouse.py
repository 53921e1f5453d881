"""The warehouse: staging, members, facts and control as Parquet tables.

Every load writes its own ``load=N`` folder in each table and becomes visible
when its row in the control table is written. A load that failed half-way is
invisible, and running it again overwrites the same folders: rows are neither
lost nor loaded twice, also when executors or the driver die in between.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.functions import timeparts
from sensorstar.operators import control, dimensions, facts, staging
from sensorstar.plans.profiles import CANON, Profile
from sensorstar.plans.segments import Manifest, SegmentStore, Table
from sensorstar.session import bounded, folders, literal_rows, pinned, removed
from sensorstar.sources.landing import incremental_scan

MEMBER_SCHEMA = "dimension string, member string, key long"
JOB_NAME = "load_camera_detections"
# The control row that counts finished loads.
LOADS_TOPIC = "#loads"
# Control rows that count the finished batches of a stream.
STREAM_TOPIC = "#stream:"
# Control rows that name the newest segments of each table.
COMPACTED_TOPIC = "#compacted:"
# Load number of the unknown members, below every real load.
SEED_LOAD = -1


@dataclass(frozen=True)
class LoadReport:
    load: int
    staged: int
    loaded: int
    new_members: int
    last_id: int
    rejected: int = 0


class Warehouse:
    """Tables under ``root``, a folder all executors share. One writer at a time."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        profile: Profile = CANON,
        start: dt.date = timeparts.CALENDAR_START,
        end: dt.date = timeparts.CALENDAR_END,
    ):
        self.spark = spark
        self.root = root
        self.profile = profile
        self.start, self.end = start, end
        self.fact_schema = facts.fact_schema(profile)
        self._marks: dict[str, int] | None = None
        self._store = SegmentStore(spark, root)
        # Tables of finished loads never change, so their file lists are kept.
        self._frames: dict[tuple, DataFrame] = {}
        self._manifests: dict[str, Manifest] = {}

    # ---- tables -------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> "Warehouse":
        """Empty tables, the calendar and the unknown members."""
        self._empty("runs", control.RUN_SCHEMA)
        minutes = dimensions.profile_calendar(self.spark, self.profile, self.start, self.end)
        minutes.write.mode("overwrite").parquet(self.path("calendar"))
        self.reset()
        return self

    def reset(self) -> None:
        """Clear facts, members and marks; keep the calendar; put the unknown
        members back. Keys start again at 1."""
        self._empty("staging", staging.STAGING_SCHEMA)
        self._empty("facts", self.fact_schema + ", week_bucket date")
        unknown = dimensions.unknown_members(self.spark, self.profile).coalesce(1)
        unknown.withColumn("load", F.lit(SEED_LOAD)).write.mode("overwrite").partitionBy("load", "dimension").parquet(
            self.path("members")
        )
        self._empty("control", control.CONTROL_SCHEMA)
        self._forget()
        for table in self._tables():
            removed(self.spark, f"{self.root}/{table}_segments")

    def _empty(self, table: str, schema: str) -> None:
        literal_rows(self.spark, schema, []).coalesce(1).write.mode("overwrite").parquet(self.path(table))

    def _tables(self) -> dict[str, Table]:
        return {
            "facts": Table("facts", self.fact_schema + ", week_bucket date", "week_bucket", ("time_key", "sensor_key")),
            "members": Table("members", MEMBER_SCHEMA, "dimension", ("member",)),
            "staging": Table("staging", staging.STAGING_SCHEMA, None, ("landing_id",)),
        }

    def _manifest(self, table: str) -> Manifest:
        """The newest segments of a table."""
        if table not in self._manifests:
            number = self._mark(f"{COMPACTED_TOPIC}{table}")
            self._manifests[table] = self._store.manifest(self._tables()[table], number, SEED_LOAD)
        return self._manifests[table]

    def _read(self, table: str, through: int, low: int = SEED_LOAD, part: str | None = None) -> DataFrame:
        """Rows of the loads from ``low`` to before ``through``, of all parts or one: what
        compaction covers from segments, later loads from their own folders."""
        key = (table, through, low, part)
        if key not in self._frames:
            of, manifest = self._tables()[table], self._manifest(table)
            found = [self._store.read(of, manifest, part) if low < manifest.upto else None]
            if through > manifest.upto:
                found.append(self._load_folders(of, max(low, manifest.upto), part))
            found = [rows.where((F.col("load") >= low) & (F.col("load") < through)) for rows in found if rows is not None]
            rows = reduce(DataFrame.unionByName, found) if found else literal_rows(self.spark, f"{of.schema}, load int", [])
            rows = rows.drop("load")
            if through > self.loads():
                return rows
            self._frames[key] = rows
        return self._frames[key]

    def _load_folders(self, table: Table, low: int, part: str | None) -> DataFrame | None:
        """Rows in the folders of loads from ``low`` on. The planner estimates a table by the
        files it lists and not by the partitions a filter leaves, so a small part is seen to
        be small, and broadcast, only if no other files are listed."""
        read = self.spark.read.schema(f"{table.schema}, load int")
        if part is None and low == SEED_LOAD:
            return read.parquet(self.path(table.name))
        inner = f"/{table.part}={part}" if part is not None else ""
        listed = folders(self.spark, f"{self.path(table.name)}/load=*{inner}")
        numbered = [(int(re.search(r"/load=(-?\d+)", path)[1]), path) for path in listed]
        paths = [path for load, path in numbered if load >= low]
        return read.option("basePath", self.path(table.name)).parquet(*paths) if paths else None

    def _mark(self, topic: str) -> int:
        """A mark of the warehouse itself; all of them are read at once."""
        if self._marks is None:
            own = self.control().where(F.col("process_step") == 0).groupBy("topic").agg(F.max("last_loaded_id"))
            self._marks = dict(own.collect())
        return self._marks.get(topic, 0)

    def loads(self) -> int:
        """Number of finished loads."""
        return self._mark(LOADS_TOPIC)

    def control(self) -> DataFrame:
        return self.spark.read.schema(control.CONTROL_SCHEMA).parquet(self.path("control"))

    def run_events(self) -> DataFrame:
        return self.spark.read.schema(control.RUN_SCHEMA).parquet(self.path("runs"))

    def calendar(self) -> DataFrame:
        if ("calendar", 0) not in self._frames:
            rows = self.spark.read.schema(dimensions.CALENDAR_SCHEMA).parquet(self.path("calendar"))
            self._frames["calendar", 0] = rows
        return self._frames["calendar", 0]

    def calendar_rows(self) -> int:
        return (self.end - self.start).days * timeparts.MINUTES_PER_DAY - self.profile.missing_minutes + 1

    def staging(self, through: int | None = None) -> DataFrame:
        return self._read("staging", self.loads() if through is None else through)

    def facts(self, through: int | None = None, low: int = SEED_LOAD) -> DataFrame:
        """Facts of finished loads, all or from load ``low`` on; a filter on ``week_bucket``
        skips other weeks."""
        return self._read("facts", self.loads() if through is None else through, low)

    def rejected(self) -> DataFrame:
        """Staging rows that the variant's rules keep from becoming facts."""
        return facts.unloadable(self.staging(), self.profile)

    def members(self, through: int | None = None) -> DataFrame:
        return self._read("members", self.loads() if through is None else through)

    def members_of(self, name: str, through: int | None = None) -> DataFrame:
        """Members of one dimension, from its own folders only."""
        return self._read("members", self.loads() if through is None else through, part=name)

    def dimension(self, name: str) -> DataFrame:
        """Key and label of one dimension.

        Not hinted: the planner broadcasts a dimension whose files it sees to be
        small and shuffles one that outgrew that.
        """
        key, label = dimensions.DIMENSION_COLUMNS[name]
        rows = self.members_of(name)
        rows = rows.select(F.col("key").alias(key), F.col("member").alias(label))
        return dimensions.active_cities(rows) if name == "city" else rows

    # ---- loading ------------------------------------------------------------

    def load(self, landing: DataFrame, topic_pattern: str, up_to_id: int | None = None) -> LoadReport:
        """Load the messages of a topic pattern that came since its last load,
        all of them or those up to an id."""
        mark = control.high_water_mark(self.control(), topic_pattern).first()[0]
        messages = incremental_scan(landing, topic_pattern, mark)
        if up_to_id is not None:
            messages = messages.where(F.col("id") <= up_to_id)
        if messages.isEmpty():
            self._log(str(uuid.uuid4()), topic_pattern, "SUCCESS", 0, None)
            return LoadReport(self.loads(), 0, 0, 0, mark)
        return self.load_messages(messages, topic_pattern, self.loads())

    def load_batch(self, messages: DataFrame, topic: str, stream: str, batch: int) -> LoadReport:
        """Load a micro-batch as the next load, unless this batch of this stream is
        done. The control row of the load says so, so both are written at once."""
        if batch < self._mark(f"{STREAM_TOPIC}{stream}"):
            return LoadReport(self.loads(), 0, 0, 0, 0)
        return self.load_messages(messages, topic, self.loads(), (f"{STREAM_TOPIC}{stream}", batch + 1))

    def load_messages(
        self, messages: DataFrame, topic: str, load: int, mark: tuple[str, int] | None = None
    ) -> LoadReport:
        """Load number ``load``; a number that is done already is skipped. ``mark`` is
        a further control row, written with the load's own."""
        if load < self.loads():
            return LoadReport(load, 0, 0, 0, 0)
        run = str(uuid.uuid4())
        self._log(run, topic, "RUNNING", 0, None)
        try:
            report = self._load(messages, load)
        except Exception as error:
            self._log(run, topic, "ERROR", 0, str(error))
            raise
        if report.staged != report.loaded + report.rejected:
            message = f"{report.staged} staged, {report.loaded} loaded, {report.rejected} rejected"
            self._log(run, topic, "ERROR", report.loaded, message)
            raise RuntimeError(message)
        self._commit(topic, load, report.last_id, mark)
        self._log(run, topic, "SUCCESS", report.loaded, None)
        return report

    def _load(self, messages: DataFrame, load: int) -> LoadReport:
        staged_path = f"{self.path('staging')}/load={load}"
        # one task a row group would read a large file of one row group alone
        staging.camera_staging(bounded(messages), self.profile).write.mode("overwrite").parquet(staged_path)
        staged = self.spark.read.schema(staging.STAGING_SCHEMA).parquet(staged_path)
        rows, last_id = staging.staging_mark(staged).first()

        counts = pinned(dimensions.member_counts(staged, self.profile.members))
        known = self.members(load)
        # Numbering reads its input twice; the comparison with all known members runs once.
        fresh = pinned(dimensions.new_members(counts, known, ["dimension", "member"]).select("dimension", "member"))
        used = (F.col("key") > 0) & (F.col("key") != self.profile.unknown_key)
        highest = known.where(used).groupBy("dimension").agg(F.max("key").alias("highest_key"))
        keyed = dimensions.dense_keys(fresh, highest)
        member_path = f"{self.path('members')}/load={load}"
        keyed.write.mode("overwrite").partitionBy("dimension").parquet(member_path)

        by_name = {d: self.members_of(d, load + 1) for d in dimensions.NATURAL_KEYS}
        hot, split = self._hot_members(counts, keyed)
        loaded = facts.star_lookup(staged, by_name, hot, self.profile, self.start, self.end, split)
        fact_path = f"{self.path('facts')}/load={load}"
        (
            loaded.withColumn("week_bucket", timeparts.week_bucket(F.col("detection_time")))
            .hint("rebalance", F.col("week_bucket"))
            .sortWithinPartitions("week_bucket", "time_key", "sensor_key")
            .write.mode("overwrite")
            .partitionBy("week_bucket")
            .parquet(fact_path)
        )
        fact_rows = self.spark.read.schema(self.fact_schema).parquet(fact_path).count()
        new = self.spark.read.schema(MEMBER_SCHEMA).parquet(member_path).count()
        rejected = facts.unloadable(staged, self.profile).count() if self.profile.velocity == "required" else 0
        return LoadReport(load, rows, fact_rows, new, last_id, rejected)

    def _hot_members(self, counts: DataFrame, keyed: DataFrame) -> tuple[DataFrame, list[str]]:
        """Members that hold many of the rows, and the dimensions among theirs that are
        too large for the planner to broadcast: only there they have to be split."""
        hot = pinned(facts.hot_members(counts))
        names = [row[0] for row in hot.select("dimension").distinct().collect()]
        if not names:
            return hot, []
        # Keys are dense, so the highest tells the number of members.
        highest = {d: key for d, key in keyed.groupBy("dimension").agg(F.max("key")).collect()}
        known = self.members(self.loads()).where(F.col("key") != self.profile.unknown_key)
        for d, key in known.groupBy("dimension").agg(F.max("key")).collect():
            highest[d] = max(key, highest.get(d, 0))
        return hot, [d for d in names if highest.get(d, 0) > facts.SMALL_DIMENSION]

    def _commit(self, topic: str, load: int, last_id: int, mark: tuple[str, int] | None) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        rows = [(LOADS_TOPIC, 0, load + 1, True, now)]
        if mark:
            rows.append((mark[0], 0, mark[1], True, now))
        if last_id:
            rows.append((topic, control.STAGE_STEP, last_id, True, now))
            rows.append((topic, control.FACT_STEP, last_id, True, now))
        marks = literal_rows(self.spark, control.CONTROL_SCHEMA, rows).coalesce(1)
        marks.write.mode("append").parquet(self.path("control"))
        self._forget()

    def _forget(self) -> None:
        self._marks = None
        self._frames.clear()
        self._manifests.clear()

    # ---- layout over many loads ---------------------------------------------

    def compact(self) -> dict[str, int]:
        """Merge the folders of all finished loads into sorted segments; rows merged per
        table. Facts of a week are sorted by time and sensor over all its files, so that a
        filter on times skips files and row groups. Readers are not disturbed: what they
        read stays until ``vacuum``."""
        through, now, marks, merged = self.loads(), dt.datetime.now(dt.timezone.utc), [], {}
        for name, table in self._tables().items():
            before = self._manifest(name)
            if before.upto >= through:
                continue
            fresh = self._load_folders(table, before.upto, None)
            fresh = fresh.where(F.col("load") < through) if fresh is not None else literal_rows(self.spark, f"{table.schema}, load int", [])
            after = self._store.compact(table, before, fresh, through)
            merged[name] = sum(rows for found in after.segments.values() for number, rows in found if number == after.number)
            marks.append((f"{COMPACTED_TOPIC}{name}", 0, after.number, True, now))
        if marks:
            literal_rows(self.spark, control.CONTROL_SCHEMA, marks).coalesce(1).write.mode("append").parquet(self.path("control"))
            self._forget()
        return merged

    def vacuum(self, keep: int = 0) -> int:
        """Delete folders that only compactions before the last ``keep`` + 1 need. Nobody may
        still read what older ones named."""
        deleted = 0
        for name, table in self._tables().items():
            newest = self._manifest(name)
            if newest.number:
                older = [self._store.manifest(table, n, SEED_LOAD) for n in range(max(newest.number - keep, 0), newest.number)]
                deleted += self._store.vacuum(table, [*older, newest])
        self._forget()
        return deleted

    def _log(self, run: str, topic: str, status: str, rows: int, message: str | None) -> None:
        event = [(run, JOB_NAME, topic, status, dt.datetime.now(dt.timezone.utc), rows, 0, message)]
        literal_rows(self.spark, control.RUN_SCHEMA, event).coalesce(1).write.mode("append").parquet(
            self.path("runs")
        )
