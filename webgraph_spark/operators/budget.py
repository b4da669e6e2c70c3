"""Storage budgets (AGG-2, WIN-3)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.operators.ordering import RANGE, in_ranges
from webgraph_spark.schemas import LIMITS


def stored_bytes(table: DataFrame) -> DataFrame:
    """Bytes stored in ``page_data`` or ``image``; an empty table holds 0."""
    return table.agg(F.coalesce(F.sum("data_size"), F.lit(0)).alias("bytes"))


def _position(order: Sequence[str]) -> Column:
    return F.struct(*order)


def _at(items: DataFrame, order: Sequence[str], row) -> Column:
    return F.struct(*[F.lit(row[name]).cast(items.schema[name].dataType).alias(name) for name in order])


def _size_class() -> Column:
    """The number of binary digits of the size: k for 2**(k - 1) <= size < 2**k, 0 for 0."""
    return F.length(F.bin(F.col("data_size"))) - (F.col("data_size") == 0).cast("int")


def _summaries(ranged: DataFrame, order: Sequence[str]) -> list[dict]:
    """In order, per range: its first position, and per size class the sum and the least size."""
    own = ranged.groupBy(RANGE, _size_class().alias("digits")).agg(
        F.sum("data_size").alias("sum"), F.min("data_size").alias("least"), F.min(_position(order)).alias("first")
    )
    ranges: dict[int, dict] = {}
    # One row per range and size class, at most 64 classes.
    for row in own.collect():
        known = ranges.setdefault(row[RANGE], {RANGE: row[RANGE], "first": row["first"], "classes": {}})
        known["first"] = min(known["first"], row["first"])
        known["classes"][row["digits"]] = (row["sum"], row["least"])
    return [ranges[r] for r in sorted(ranges)]


def _admit(left: int, sizes: list[int]) -> tuple[list[bool], int]:
    """The rule itself, item by item; and what is left."""
    admitted = []
    for size in sizes:
        fits = size < left
        left -= size if fits else 0
        admitted.append(fits)
    return admitted, left


def _in_order(lefts: dict[int, int]):
    """Admission inside ranges whose items come in order; ``lefts`` is what is left of the budget before each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = dict(lefts)
        for batch in batches:
            sizes, ranges = batch.column("data_size").to_pylist(), batch.column(RANGE).to_pylist()
            found, start = [], 0
            while start < len(ranges):
                end = next((i for i in range(start, len(ranges)) if ranges[i] != ranges[start]), len(ranges))
                part, now[ranges[start]] = _admit(now[ranges[start]], sizes[start:end])
                found += part
                start = end
            kept = batch.drop_columns([RANGE]).append_column("admitted", pa.array(found))
            yield kept.filter(kept.column("admitted"))

    return work


def _opened(ranged: DataFrame, order: Sequence[str], lefts: dict[int, int]) -> DataFrame:
    """The admitted items (order, data_size, admitted) of the ranges in ``lefts``."""
    rows = ranged.where(F.col(RANGE).isin(list(lefts))).repartition(RANGE).sortWithinPartitions(RANGE, *order)
    kinds = dict(ranged.dtypes)
    columns = [f"`{name}` {kinds[name]}" for name in [*order, "data_size"]]
    return rows.select(*order, "data_size", RANGE).mapInArrow(_in_order(lefts), ", ".join([*columns, "admitted boolean"]))


def byte_budget(
    items: DataFrame, order: Sequence[str], limit: int = LIMITS.max_stored_bytes, stored: int = 0
) -> DataFrame:
    """Adds ``admitted``: in order, an item is refused when it would bring the bytes to ``limit``.

    A refused item is skipped and later smaller ones may still enter. items has
    data_size and the ``order`` columns, which are unique per row and not NULL.

    The order is cut into ranges, and each range is summed by size class (powers of two). While the rest of the budget has
    k + 1 binary digits, sizes of at most k digits always fit and those of more than k + 1 never do. So a range is passed by its
    sums alone unless the rest loses a digit in it or an item of k + 1 digits may fit, which takes a digit too. Only
    such ranges are opened, a task each; there are at most as many as the budget has binary digits, and a few that look so.
    """
    order = list(order)
    ranged = in_ranges(items.select(*order, F.col("data_size").cast("long").alias("data_size")), order)
    left = limit - stored
    segments: list[tuple] = []  # first position, sizes below which items are admitted (None: the range is opened)
    lefts: dict[int, int] = {}
    for own in _summaries(ranged, order):
        # 2**digits < left <= 2**(digits + 1)
        digits = max(left - 1, 0).bit_length() - 1
        small = sum(total for k, (total, _) in own["classes"].items() if k <= digits)
        large = own["classes"].get(digits + 1)
        if left <= 1:
            below = max(left, 0)  # nothing, or what takes no room
        elif left - small > 2**digits and (large is None or large[1] >= left):
            below, left = 2**digits, left - small
        else:
            below, lefts[own[RANGE]] = None, left
            taken = _opened(ranged, order, {own[RANGE]: left}).agg(F.coalesce(F.sum("data_size"), F.lit(0))).first()[0]
            left -= taken
        if not segments or segments[-1][1] != below or below is None:
            segments.append((own["first"], below))
    if not segments:
        return items.withColumn("admitted", F.lit(False))
    position = _position(order)
    passed = F.lit(False)
    for first, below in segments:
        here = F.lit(False) if below is None else F.coalesce(F.col("data_size") < below, F.lit(False))
        passed = F.when(position >= _at(items, order, first), here).otherwise(passed)
    marked = items.withColumn("_passed", passed)
    if not lefts:
        return marked.withColumnRenamed("_passed", "admitted")
    chosen = _opened(ranged, order, lefts).select(*order, F.col("admitted").alias("_chosen"))
    joined = marked.join(chosen, order, "left").withColumn("admitted", F.col("_passed") | F.coalesce("_chosen", F.lit(False)))
    return joined.select(*items.columns, "admitted")
