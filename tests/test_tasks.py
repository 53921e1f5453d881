"""Costly work is dealt out by rows, and payloads of one shape are measured once."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from sensorstar import session
from sensorstar.functions import payload
from sensorstar.operators import flatten
from sensorstar.plans import warehouse
from sensorstar.plans.warehouse import Warehouse
from sensorstar.sources.sample_landing import camera_landing


def one_row_group(spark, folder):
    """A file of many splits, of which one holds all rows."""
    spark.range(0, 200_000, 1, 1).select("id", F.md5(F.col("id").cast("string")).alias("text")).write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def rows_by_task(df):
    return [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]


def test_spread_looks_at_rows_not_at_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500000")
    try:
        rows = one_row_group(spark, tmp_path / "one")
        assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert max(rows_by_task(rows)) == 200_000
        dealt = rows_by_task(session.spread(rows))
        assert max(dealt) < 60_000 and sum(dealt) == 200_000
        small = rows_by_task(session.spread(rows, 10_000))
        assert len(small) == 20 and max(small) < 12_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_few_rows_are_not_spread(spark):
    rows = spark.range(0, 80, 1, 8)
    assert session.spread(rows) is rows
    assert session.bounded(spark.range(0, 80, 1, 2), 40).rdd.getNumPartitions() == 2
    assert session.bounded(spark.range(0, 100, 1, 1), 10).rdd.getNumPartitions() == 10
    assert session.spread(rows.where("id < 0")).count() == 0
    assert session.bounded(rows.where("id < 0")).count() == 0


def test_a_load_of_one_row_group_is_staged_by_several_tasks(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "bounded", lambda rows: session.bounded(rows, 100))
    messages = camera_landing(spark, sf_dir).coalesce(1)
    tables = Warehouse(spark, str(tmp_path / "wh")).create()
    report = tables.load(messages, "%")
    assert report.staged == messages.count()
    assert len(list((tmp_path / "wh" / "staging" / "load=0").glob("*.parquet"))) > 2


def test_nesting_of_shapes_is_that_of_their_texts(spark):
    inner = json.dumps({"a": {"b": [{"c": {"d": 1}}]}})
    texts = [
        inner, json.dumps({"x": inner}), json.dumps({"x": "\\" + inner, "y": [[[[[1]]]]]}), '{"a":"{{{{{{', r'{"a\"{{{{":[[{"b":1}]]}',
        "[1,{}] {{{{", None, "", "plain",
    ]
    for text in texts:
        rows = spark.createDataFrame([(text,)], "payload string")
        whole = rows.select(flatten.nesting(F.col("payload"))).first()[0]
        few = (text or "").count("{") + (text or "").count("[")
        assert flatten.nesting_bound(rows) == (few if few <= 3 else whole) + 2


def test_tails_after_a_second_element_are_seen(spark):
    texts = {'1,"x"] tail': None, "1,2": None, "1] x": None, '{"a":1}] {}': None, '[{"a":1},"]"]': '[{"a":1},"]"]', " [1] ": "[1]", "-1": "-1"}
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = rows.select("text", F.to_json(payload.json_value(F.col("text"))).alias("value")).collect()
    assert {r["text"]: r["value"] for r in found} == texts
