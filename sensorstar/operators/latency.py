"""Statistics of measured latencies ``(database, concurrency, latency, started, ended)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.operators.numbering import running_total
from sensorstar.session import broadcast_counted

GROUP = ["database", "concurrency"]
# The 95th percentile is cut 19 of 20 quantiles.
CUT, QUANTILES = 19, 20


def exclusive_p95(latencies: DataFrame) -> DataFrame:
    """95th percentile per group by the exclusive method, exact.

    The position ``19 (n + 1) / 20`` lies between two order statistics (or is
    extrapolated from the last two). Equal latencies are counted first and the
    counts are summed up along the order over many partitions, so no group is
    ever collected.
    """
    counted = latencies.groupBy(*GROUP, "latency").agg(F.count("*").alias("copies"))
    placed = running_total(counted, GROUP, ["latency"], "copies", "through")
    totals = counted.groupBy(*GROUP).agg(F.sum("copies").alias("n"))
    position = (F.col("n") + 1) * CUT
    whole = F.expr(f"((n + 1) * {CUT}) div {QUANTILES}")
    low = F.greatest(F.lit(1), F.least(whole, F.col("n") - 1))
    bounds = totals.select(*GROUP, low.alias("low"), (position - low * QUANTILES).alias("rest"))
    at_low = F.min(F.when(F.col("through") >= F.col("low"), F.col("latency")))
    at_next = F.min(F.when(F.col("through") >= F.col("low") + 1, F.col("latency")))
    found = placed.join(broadcast_counted(bounds), GROUP).groupBy(*GROUP, "rest").agg(at_low.alias("d0"), at_next.alias("d1"))
    between = (F.col("d0") * (QUANTILES - F.col("rest")) + F.col("d1") * F.col("rest")) / QUANTILES
    return found.select(*GROUP, F.coalesce(between, "d0").alias("p95"))


def latency_summary(latencies: DataFrame) -> DataFrame:
    """Average, 95th percentile, extremes and number of queries, four digits."""
    plain = latencies.groupBy(*GROUP).agg(
        F.round(F.avg("latency"), 4).alias("avg_latency_s"),
        F.round(F.min("latency"), 4).alias("min_latency_s"),
        F.round(F.max("latency"), 4).alias("max_latency_s"),
        F.count("*").alias("total_queries"),
    )
    p95 = exclusive_p95(latencies).select(*GROUP, F.round("p95", 4).alias("p95_latency_s"))
    return plain.join(p95, GROUP)


def throughput(latencies: DataFrame) -> DataFrame:
    """Completed queries per second of wall time."""
    seconds = F.max("ended") - F.min("started")
    return latencies.groupBy(*GROUP).agg(F.round(F.count("*") / seconds, 2).alias("tps"))


def refreshed(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored results, those of the databases tested again replaced."""
    kept = stored.join(fresh.select("database").distinct(), "database", "left_anti")
    return kept.unionByName(fresh)


def tps_pivot(results: DataFrame, databases: Sequence[str]) -> DataFrame:
    """Throughput by concurrency, one column per database."""
    return results.groupBy("concurrency").pivot("database", list(databases)).agg(F.first("tps"))
