"""Dense running numbers without a single-task window.

Rows are range-partitioned and sorted, then pinned, so that partition numbers
mean the same in every later pass. Each partition then only needs the number of
rows before it; that offset table has one row per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstar.session import broadcast_counted, pinned

# monotonically_increasing_id() keeps the row position in its lower 33 bits.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str], number: str) -> DataFrame:
    """``row_number() over (order by …)`` for any number of rows. ``order`` should
    be unique: rows that are equal in it share a partition."""
    fixed = pinned(df.repartitionByRange(*order).sortWithinPartitions(*order))
    offsets = (
        fixed.groupBy(F.spark_partition_id().alias("_part"))
        .count()
        .select("_part", _before("count", Window.orderBy("_part")).alias("_offset"))
    )
    place = F.monotonically_increasing_id()
    placed = fixed.withColumn("_place", place)
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS).cast("int"))
    row = F.col("_place") - F.shiftleft(F.col("_part").cast("long"), _ROW_BITS)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(number, row + F.col("_offset") + 1)
        .drop("_place", "_part", "_offset")
    )


def number_rows_within(df: DataFrame, groups: Sequence[str], order: Sequence[str], number: str) -> DataFrame:
    """``row_number() over (partition by groups order by …)``, also for a group
    that holds most rows: it spreads over partitions like any other range."""
    numbered = number_rows(df, [*groups, *order], number)
    first = numbered.groupBy(*groups).agg(F.min(number).alias("_first"))
    return numbered.join(broadcast_counted(first), list(groups)).withColumn(number, F.col(number) - F.col("_first") + 1).drop("_first")


def running_total(df: DataFrame, groups: Sequence[str], order: Sequence[str], amount: str, total: str) -> DataFrame:
    """``sum(amount) over (partition by groups order by …)`` up to each row."""
    return running_totals(df, groups, order, {amount: total})


def running_totals(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], amounts: Mapping[str, str], wholes: Mapping[str, str] | None = None
) -> DataFrame:
    """The same for several amounts at once, from one sort; ``wholes`` names columns for
    the sum of an amount over its whole group.

    ``groups`` and ``order`` together must be unique. A group may span many
    partitions; what earlier partitions hold of it is added as an offset.
    """
    keys, wholes = [*groups, *order], wholes or {}
    fixed = pinned(df.repartitionByRange(*keys).sortWithinPartitions(*keys)).withColumn(
        "_part", F.spark_partition_id()
    )
    summed = dict.fromkeys([*amounts, *wholes])
    sums = fixed.groupBy(*groups, "_part").agg(*[F.sum(amount).alias(f"_sum_{amount}") for amount in summed])
    in_order, everything = Window.partitionBy(*groups).orderBy("_part"), Window.partitionBy(*groups)
    offsets = [_before(f"_sum_{amount}", in_order).alias(f"_offset_{amount}") for amount in amounts]
    whole = [F.sum(f"_sum_{amount}").over(everything).alias(name) for amount, name in wholes.items()]
    earlier = sums.select(*groups, "_part", *offsets, *whole)
    local = Window.partitionBy("_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for amount, total in amounts.items():
        fixed = fixed.withColumn(total, F.sum(amount).over(local))
    joined = fixed.join(earlier, [*groups, "_part"])
    joined = joined.withColumns({total: F.col(total) + F.col(f"_offset_{amount}") for amount, total in amounts.items()})
    return joined.drop("_part", *[f"_offset_{amount}" for amount in amounts])


def _before(amount: str, window: Window) -> Column:
    rows = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(rows), F.lit(0))
