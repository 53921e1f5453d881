"""Roll-ups kept up over loads."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest

from sensorstar.plans.rollups import Rollup, RollupStore
from sensorstar.plans.semantic import Filter, camera_cube
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import literal_rows

MEASURES = ("detections", "avg_velocity", "max_velocity", "sum_velocity")
ROLLUPS = (
    Rollup("small", MEASURES, ("city_name",)),
    Rollup("large", MEASURES, ("city_name", "sensor_code", "full_date")),
    Rollup("counts", ("detections",), ("sensor_code",)),
)


@pytest.fixture
def stored(spark, tmp_path):
    rows = []
    for n in range(1, 121):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * n)
        velocity = "null" if n % 13 == 0 else n % 80
        rows.append((n, at, f"/City{n % 3}/kamery/camea/1", '{"lp":"P%d","sensor":"S%d","velocity":%s}' % (n % 7, n % 4, velocity)))
    landing = literal_rows(spark, "id long, time timestamp_ntz, topic string, payload string", rows)
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"), end=dt.date(2024, 2, 1)).create()
    kept = RollupStore(warehouse, camera_cube(warehouse), str(tmp_path / "rollups"), ROLLUPS).create()
    return warehouse, kept, landing


def same(kept, measures, dimensions, filters=(), grain=None):
    found, expected = (
        Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in source.query(measures, dimensions, filters, grain).collect())
        for source in (kept, kept.cube)
    )
    assert found == expected and found
    return True


def test_only_new_facts_are_read_and_answers_equal_a_rebuild(stored):
    warehouse, kept, landing = stored
    assert kept.choose(["detections"], ["city_name"]) is None and kept.refresh() == {}
    for load, up_to in enumerate((40, 80, 100, 120)):
        warehouse.load(landing, "%", up_to_id=up_to)
        reads = warehouse.facts(load + 1, load).inputFiles()
        assert reads and all(f"/load={load}/" in name for name in reads)
        # Before the refresh the last load's facts are added, after it they are stored.
        if load:
            assert same(kept, MEASURES, ["city_name"])
        seen, facts = [], warehouse.facts
        warehouse.facts = lambda through=None, low=-1: seen.append((low, through)) or facts(through, low)
        kept.refresh()
        del warehouse.facts
        assert set(seen) == {(load, load + 1)}
        assert same(kept, MEASURES, ["city_name"]) and same(kept, MEASURES, ["city_name", "sensor_code"])
    assert kept.refresh() == {}
    assert same(kept, MEASURES, []) and same(kept, MEASURES, ["full_date"], grain="day")
    warehouse.compact()
    warehouse.vacuum()
    assert same(kept, MEASURES, ["sensor_code"], [Filter("city_name", "equals", "City1")])
    again = RollupStore(warehouse, kept.cube, kept.root + "-again", ROLLUPS).create()
    again.refresh()
    for rollup in ROLLUPS:
        assert same(again, rollup.measures, rollup.dimensions) and same(kept, rollup.measures, rollup.dimensions)


def test_the_smallest_that_covers_a_request(stored):
    warehouse, kept, landing = stored
    warehouse.load(landing, "%")
    kept.refresh()
    assert kept.choose(["detections"], ["city_name"]) == "small"
    assert kept.choose(["detections"], ["sensor_code"]) == "counts"
    assert kept.choose(["max_velocity"], ["sensor_code"]) == "large"
    assert kept.choose(["detections"], ["city_name"], [Filter("sensor_code", "equals", "S1")]) == "large"
    assert kept.choose(["min_velocity"], ["city_name"]) is None
    assert kept.choose(["detections"], ["license_plate"]) is None
    assert same(kept, ["min_velocity"], ["city_name"]) and same(kept, ["unique_plates"], ["city_name"])
    read = kept.query(["max_velocity"], ["city_name"]).inputFiles()
    assert read and all("/rollups/small/" in name for name in read)


def test_a_refresh_that_dies_is_repeated(stored, monkeypatch):
    warehouse, kept, landing = stored
    warehouse.load(landing, "%", up_to_id=60)
    kept.refresh()
    warehouse.load(landing, "%")
    merged = kept.cube.__class__.merged
    calls = []

    def dying(self, states, measures, dimensions):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("lost")
        return merged(self, states, measures, dimensions)

    monkeypatch.setattr(kept.cube.__class__, "merged", dying)
    with pytest.raises(RuntimeError, match="lost"):
        kept.refresh()
    monkeypatch.setattr(kept.cube.__class__, "merged", merged)
    assert same(kept, MEASURES, ["city_name"]) and same(kept, MEASURES, ["city_name", "sensor_code"])
    kept.refresh()
    assert {k.upto for k in kept.kept().values()} == {2} and same(kept, MEASURES, ["city_name"])


def test_distinct_counts_are_refused(stored):
    warehouse, kept, _ = stored
    with pytest.raises(ValueError, match="distinct"):
        RollupStore(warehouse, kept.cube, kept.root, [Rollup("plates", ("unique_plates",), ("city_name",))])
