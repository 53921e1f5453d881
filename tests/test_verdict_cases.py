"""Cases that once gave wrong answers: depth, neighbours, ranges, streams, files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorstar.operators import discovery, flatten
from sensorstar.plans.profiles import CLICKHOUSE
from sensorstar.sources.sample_landing import camera_landing as landing
from sensorstar.plans.warehouse import Warehouse
from sensorstar.session import literal_rows
from sensorstar.sources import delimited
from sensorstar.streaming.incremental import stream_load

PATTERN = "/%/kamery/camea/%"


def _leaves(spark, *payloads):
    rows = literal_rows(spark, "id long, payload string", list(enumerate(payloads)))
    found = flatten.leaf_rows(flatten.flattened(rows), "id").collect()
    return {n: {r["path"]: r["text"] for r in found if r["id"] == n} for n in range(len(payloads))}


def test_a_payload_of_25_levels_is_flattened_whole(spark):
    payload = '{"k":' * 25 + "1" + "}" * 25
    assert _leaves(spark, payload)[0] == {"_".join("k" * 25): "1"}


def test_a_row_does_not_depend_on_its_neighbours(spark):
    odd = ["{'a': \"x\"}", '{"a":"{\'b\':2}"}', '{"a":"}}","b":{"c":{"d":1}}}', "{broken", '{"a":[{"b":1},{"b":2}]}']
    together = _leaves(spark, *odd, '{"a":{"b":{"c":{"d":{"e":1}}}}}')
    for place, payload in enumerate(odd):
        assert _leaves(spark, payload)[0] == together[place]


def test_older_modes_keep_the_last_of_equal_names(spark):
    rows = literal_rows(spark, "id long, payload string", [(1, '{"a-b":1,"a.b":2}')])
    found = flatten.leaf_rows(flatten.flattened_elements(rows, "first"), "id").collect()
    assert [r["text"] for r in found] == ["2"]


def test_impossible_dates_are_text(spark):
    texts = ["2024-02-30", "2023-W53", "2020-W53", "0000-01-01", "2024-02-29T10:00:00Z", "20240230", "20240229"]
    rows = literal_rows(spark, "text string", [(t,) for t in texts])
    typed = rows.select("text", discovery.column_type(F.col("text").cast("variant")).alias("type"))
    times = {r["text"] for r in typed.collect() if r["type"] == "TIMESTAMPTZ"}
    assert times == {"2020-W53", "2024-02-29T10:00:00Z", "20240229"}


def test_handoff_files_return_what_was_written(spark, tmp_path):
    texts = ["a\nb", "", None, "\\N", 'q"u"o', "c,d", "\\", "\\n", "x\r\ny", " pad ", "tail\\"]
    rows = list(enumerate(texts))
    delimited.write_handoff(spark.createDataFrame(rows, "id long, text string"), str(tmp_path / "h"))
    back = delimited.read_handoff(spark, str(tmp_path / "h"), "id long, text string").orderBy("id")
    assert [(r["id"], r["text"]) for r in back.collect()] == rows


def test_another_calendar_range_finds_its_own_minutes(spark, sf_dir, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), start=dt.date(2023, 1, 1), end=dt.date(2025, 1, 1)).create()
    warehouse.load(landing(spark, sf_dir), PATTERN)
    facts = warehouse.facts().join(warehouse.calendar(), "time_key")
    minute = F.date_trunc("minute", "detection_time").cast("timestamp_ntz")
    assert facts.count() == warehouse.facts().count()
    assert facts.where(minute != F.col("full_date")).isEmpty()


def test_an_unsigned_unknown_key_is_no_used_key(spark, sf_dir, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), CLICKHOUSE).create()
    warehouse.load(landing(spark, sf_dir), PATTERN)
    cities = {r["key"] for r in warehouse.members_of("city").collect()}
    assert cities - {CLICKHOUSE.unknown_key} == set(range(1, len(cities)))


def test_a_stream_after_a_load_loses_nothing(spark, sf_dir, tmp_path):
    source = str(tmp_path / "landing")
    messages = landing(spark, sf_dir).where(F.col("topic").like(PATTERN))
    middle = messages.agg(F.percentile_approx("id", 0.5)).first()[0]
    messages.where(F.col("id") > middle).repartition(2).write.parquet(source)
    warehouse = Warehouse(spark, str(tmp_path / "w")).create()
    warehouse.load(messages, PATTERN, middle)
    for _ in range(2):
        stream_load(spark, source, warehouse, PATTERN, str(tmp_path / "c"), files_per_batch=1)
    assert warehouse.facts().count() == messages.count()


@pytest.mark.parametrize("name", ["city", "sensor"])
def test_small_dimensions_are_read_from_their_own_folders(spark, sf_dir, tmp_path, name):
    warehouse = Warehouse(spark, str(tmp_path / "w")).create()
    warehouse.load(landing(spark, sf_dir), PATTERN)
    files = warehouse.members_of(name).inputFiles()
    assert files and all(f"dimension={name}" in f for f in files)
