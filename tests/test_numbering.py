from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from sensorstar.operators import latency, numbering


def test_numbers_without_gaps(spark):
    rows = [(i, f"m{i:05d}") for i in range(3000)]
    random.Random(1).shuffle(rows)
    found = numbering.number_rows(spark.createDataFrame(rows, "i int, m string").repartition(7), ["m"], "n").collect()
    assert all(r["n"] == r["i"] + 1 for r in found)


def test_numbers_within_groups_one_of_them_hot(spark):
    rows = [("hot" if i % 10 else f"g{i % 70}", f"m{i:05d}") for i in range(4000)]
    found = numbering.number_rows_within(spark.createDataFrame(rows, "g string, m string"), ["g"], ["m"], "n").collect()
    by_group: dict[str, list[str]] = {}
    for g, m in sorted(rows):
        by_group.setdefault(g, []).append(m)
    assert all(by_group[r["g"]][r["n"] - 1] == r["m"] for r in found) and len(found) == len(rows)


def test_running_total(spark):
    rows = [("hot" if i % 3 else "cold", i, i % 11) for i in range(3000)]
    found = numbering.running_total(spark.createDataFrame(rows, "g string, i int, x long"), ["g"], ["i"], "x", "t").collect()
    totals: dict[str, int] = {}
    wanted = {}
    for g, i, x in rows:
        totals[g] = totals.get(g, 0) + x
        wanted[g, i] = totals[g]
    assert {(r["g"], r["i"]): r["t"] for r in found} == wanted


@pytest.mark.parametrize(
    "values",
    [[1, 2, 3, 4, 10], [5.0, 5.0], [1.0] * 40, [float(i % 7) for i in range(200)], [random.Random(3).random() for _ in range(999)]],
)
def test_p95_is_the_exclusive_quantile(spark, values):
    rows = [("db", 1, float(v), 0.0, 1.0) for v in values]
    calls = spark.createDataFrame(rows, "database string, concurrency int, latency double, started double, ended double")
    found = latency.exclusive_p95(calls).first()["p95"]
    assert found == pytest.approx(statistics.quantiles(values, n=20)[18])


def test_summary_of_the_known_case(spark):
    rows = [("db", 1, float(v), float(v), v + 1.0) for v in (1, 2, 3, 4, 10)]
    calls = spark.createDataFrame(rows, "database string, concurrency int, latency double, started double, ended double")
    row = latency.latency_summary(calls).first()
    assert (row["avg_latency_s"], row["p95_latency_s"], row["max_latency_s"], row["total_queries"]) == (4.0, 14.2, 10.0, 5)
    assert latency.throughput(calls).first()["tps"] == 0.5


def test_refresh_and_pivot(spark):
    kind = "database string, concurrency int, tps double"
    stored = spark.createDataFrame([("a", 1, 1.0), ("a", 5, 2.0), ("b", 1, 3.0)], kind)
    fresh = spark.createDataFrame([("a", 1, 9.0)], kind)
    result = latency.refreshed(stored, fresh)
    assert sorted(map(tuple, result.collect())) == [("a", 1, 9.0), ("b", 1, 3.0)]
    pivot = latency.tps_pivot(result, ["a", "b"]).orderBy("concurrency").collect()
    assert [tuple(r) for r in pivot] == [(1, 9.0, 3.0)]


def test_offsets_hold_one_row_per_partition(spark):
    frame = numbering.number_rows(spark.range(1000).select(F.col("id").alias("m")), ["m"], "n")
    assert frame.agg(F.max("n")).first()[0] == 1000
