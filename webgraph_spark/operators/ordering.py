"""Work over one global order without bringing it into one task.

Rows are cut into ranges of the order, one per partition. Each range is handled
on its own and the ranges meet only through one summary row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.session import cut_lineage

RANGE = "_range"


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` plus the number of its range; the order must be unique per row.

    Range bounds are sampled, so the result is written once and read back:
    every later pass must see the same ranges.
    """
    ranged = df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id())
    return cut_lineage(ranged, "ranges")


def range_offsets(ranged: DataFrame, value: Column, name: str) -> DataFrame:
    """Per range the sum of ``value`` over all earlier ranges (one row per range)."""
    sums = ranged.groupBy(RANGE).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(RANGE, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(name))


def running_total(ranged: DataFrame, value: Column, order: Sequence[str], name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before this one (exclusive)."""
    offsets = range_offsets(ranged, value, "_offset")
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return (
        ranged.withColumn("_local", local)
        .join(F.broadcast(offsets), RANGE)
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_offset", "_local")
    )


def number_rows(df: DataFrame, order: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """Adds a gap-free number in ``order``, counted from ``first``."""
    ranged = in_ranges(df, order)
    numbered = running_total(ranged, F.lit(1), order, "_before")
    return numbered.withColumn(name, (F.col("_before") + first).cast("bigint")).drop("_before", RANGE)
