"""What the plans of some operators must and must not hold."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorstar.operators import control, dimensions, facts, numbering
from sensorstar.sources import landing


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return plan(df).count("FileScan")


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "messages")
    payload = F.when(F.col("id") % 5 != 0, F.concat(F.lit("p"), F.col("id").cast("string")))
    topic = F.when(F.col("id") % 4 != 0, (F.col("id") % 4).cast("string"))
    rows = spark.range(1, 201).withColumn("topic", topic).withColumn("payload", payload)
    twice = rows.where("id > 190").withColumn("payload", F.concat("payload", F.lit("b")))
    rows.unionByName(twice).withColumn("time", F.lit(dt.datetime(2024, 1, 1))).write.parquet(path)
    return spark.read.parquet(path)


def test_newest_payloads_are_not_sorted(messages):
    found = landing.latest_payloads(messages)
    assert "SortAggregate" not in plan(found) and "Sort [" not in plan(found)
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == [("1", "p197b", 197), ("2", "p198b", 198), ("3", "p199b", 199), (None, "p196b", 196)]


def test_newest_rows_are_neither_sorted_nor_shuffled_whole(spark, messages):
    found = dimensions.latest_per_key(messages, ["topic"], ["time", "id"])
    shown = plan(found)
    assert "SortAggregate" not in shown and "SortMergeJoin" not in shown
    assert sorted((r["topic"] or "", r["id"], r["payload"] or "") for r in found.collect()) == [
        ("", 200, ""), ("1", 197, "p197b"), ("2", 198, "p198b"), ("3", 199, "p199b"),
    ]


def test_newest_rows_of_keys_with_one_row_and_ties(spark):
    rows = [(1, None, "a"), (1, 5, "b"), (1, 5, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f"), (3, 7, "g"), (3, 7, "g")]
    df = spark.createDataFrame(rows, "k int, v int, x string")
    found = dimensions.latest_per_key(df, ["k"], ["v"]).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, 5, "c"), (2, None, "d"), (None, 2, "f"), (3, 7, "g")], key=str)
    keys_only = dimensions.latest_per_key(df.select("k"), ["k"], ["k"]).collect()
    assert sorted(map(tuple, keys_only), key=str) == sorted([(1,), (2,), (3,), (None,)], key=str)
    assert dimensions.latest_per_key(df.limit(0), ["k"], ["v"]).count() == 0


def test_orphans_of_all_dimensions_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(100).selectExpr("CAST(id % 5 AS INT) AS a_key", "id % 7 AS b_key", "-1L AS c_key").write.parquet(path)
    known = {"a_key": spark.range(5).selectExpr("id AS a_key"), "b_key": spark.range(5).selectExpr("id AS b_key"), "c_key": spark.range(1).selectExpr("id AS c_key")}
    found = facts.orphan_keys(spark.read.parquet(path), known)
    assert scans(found) == 1
    assert sorted(map(tuple, found.collect())) == [("a_key", 0, 0), ("b_key", 2, 28), ("c_key", 1, 100)]


def test_progress_sorts_once(spark, monkeypatch):
    batches = spark.range(1, 51).selectExpr("IF(id % 2 = 0, 'x', 'y') AS job", "id AS batch_no", "id * 2 AS rows", "id AS seconds")
    written = []
    pinned = numbering.pinned
    monkeypatch.setattr(numbering, "pinned", lambda df: written.append(plan(df)) or pinned(df))
    found = control.progress(batches)
    assert len(written) == 1 and written[0].count("rangepartitioning") == 1 and "rangepartitioning" not in plan(found)
    last = {r["job"]: r for r in found.collect() if r["batch_no"] > 48}
    assert last["x"]["rows_so_far"] == 1300 and last["x"]["percent_done"] == 100 and last["y"]["rows_per_second"] == 2
