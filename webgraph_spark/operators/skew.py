"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A key is hot when it holds at least HOT_ROWS rows and one in HOT_SHARE of all rows, so there are
# never more than HOT_SHARE hot keys: the list is safe to collect and to broadcast
# at any scale. A key below HOT_ROWS rows fits one task and is never hot.
HOT_SHARE = 65_536
HOT_ROWS = 100_000
# Parts that rows without a key are spread over.
NULL_PARTS = 1024


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows per key; partial aggregation keeps the shuffle at one row per task and key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(counts: DataFrame, key: Sequence[str], rows: str = "_rows", hot_rows: int = HOT_ROWS) -> DataFrame:
    """At most ``HOT_SHARE`` keys, NULL among them, with the number of parts their rows are split into."""
    total = counts.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    hot = counts.where((F.col(rows) >= hot_rows) & (F.col(rows) * HOT_SHARE >= total))
    most = F.greatest(F.lit(hot_rows), F.lit(total) / HOT_SHARE)
    return hot.select(*key, F.ceil(F.col(rows) * 2 / most).cast("int").alias("_parts"))


def planned_bytes(df: DataFrame) -> int:
    """What the optimiser takes ``df`` to hold at most; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_bytes(spark: SparkSession) -> int:
    """The size up to which the optimiser broadcasts a table."""
    return max(0, int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))


def spread_join(
    big: DataFrame,
    lookup: DataFrame,
    key: Sequence[str],
    how: str = "left",
    row_id: Sequence[str | Column] = (),
    counts: DataFrame | None = None,
    rows: str = "_rows",
    hot_rows: int = HOT_ROWS,
    lookup_bytes: int | None = None,
) -> DataFrame:
    """``big.join(lookup, key, how)`` for how in inner, left, left_semi, left_anti.

    Rows of a hot key are spread by a hash of ``row_id`` over several parts and
    the lookup rows of that key are repeated once per part; all other keys
    take part in the same join with one part. Without a hot key it is the plain join. So it is for a lookup that the optimiser
    puts at no more than ``lookup_bytes`` (by default what it broadcasts): no key is hot then. Finding hot keys counts
    ``big`` by key when the plan is made; ``counts`` (key, ``rows``) saves that pass where the caller has the numbers already.
    """
    key = list(key)
    enough = broadcast_bytes(big.sparkSession) if lookup_bytes is None else lookup_bytes
    if planned_bytes(lookup) <= enough:
        return big.join(lookup, key, how)
    found = hot_keys(key_counts(big, key) if counts is None else counts, key, rows, hot_rows)
    listed = found.collect()
    if not listed:
        return big.join(lookup, key, how)
    hot = F.broadcast(big.sparkSession.createDataFrame(listed, found.schema))
    # NULL keys match nothing, but a left join still sends them all to one task.
    unknown = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in key])
    parts = F.when(unknown, F.lit(NULL_PARTS)).otherwise(F.coalesce("_parts", F.lit(1)))
    part = F.pmod(F.xxhash64(*row_id), parts).cast("int")
    left = big.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    right = lookup.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), last))).drop("_parts")
    return left.join(right, [*key, "_part"], how).drop("_part")
