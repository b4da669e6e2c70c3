"""Shards that match the mixture of sources: proportional stratified interleaving.

Rows of each source are ranked in a seeded shuffle; the fractional rank
(rank - 1/2) / rows of the source spreads every source evenly over (0, 1). In the order
of fractional ranks any stretch holds every source in its share, so cutting that
order into equal stretches gives shards of the same mixture.

Both the ranks and the global order are counted in buckets: a histogram gives the rows
before a bucket, and only rows of one bucket are sorted together. So neither a source with
a third of all rows nor the whole order ever lies in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.llm.common import same, whole_text
from webgraph_spark.session import cut_lineage

# Hex digits of the shuffle that make a bucket inside a source, and buckets of the global order.
DIGITS = 3
BUCKETS = 16_384


def shuffle_key(seed: str, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 8 for the row."""
    return (F.octet_length(whole_text(text)) + 8).cast("long")


def fractional_ranks(rows: DataFrame) -> DataFrame:
    """``rows`` (source, key, ...) with place: the fractional rank inside the source.

    Ties of the shuffle are broken by id, checksum and size; rows equal in all of
    these are interchangeable.
    """
    rows = rows.withColumn("_bucket", F.substring("key", 1, DIGITS))
    counts = rows.groupBy("source", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy("source")
    before = inside.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "source",
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(inside).alias("_rows"),
    )
    order = Window.partitionBy("source", "_bucket").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = same(rows.withColumn("_rank", F.row_number().over(order)), counts, ["source", "_bucket"], "inner")
    rank = F.col("_before") + F.col("_rank")
    return ranked.withColumn("place", (rank * 2 - 1).cast("double") / (F.col("_rows") * 2)).drop(
        "_bucket", "_before", "_rank", "_rows"
    )


def shard(docs: DataFrame, shards: int = 24, seed: str = "shard") -> DataFrame:
    """(doc_id, source, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    The law is ``rows``: counts of shards differ by at most one; ``slot`` numbers the rows
    of a shard from 0 in interleaved order. NULL texts have size 8 and checksum 0, a NULL source
    is a source of its own, NULL ids come first in a tie. With fewer rows than shards some shards
    stay empty; an empty table gives an empty table. Equal texts are not held together: the
    law is about counts alone.
    """
    narrow = docs.select(
        "doc_id",
        "source",
        text_size(F.col("text")).alias("size"),
        F.crc32(whole_text().cast("binary")).cast("long").alias("text_crc32"),
        shuffle_key(seed, F.col("doc_id")).alias("key"),
    )
    placed = fractional_ranks(cut_lineage(narrow, "shard-rows"))
    placed = placed.withColumn("_bucket", F.floor(F.col("place") * BUCKETS).cast("int"))
    placed = cut_lineage(placed, "shard-places")
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_rows"),
    )
    order = Window.partitionBy("_bucket").orderBy(
        "place", F.col("source").asc_nulls_last(), "key", "doc_id", "text_crc32", "size"
    )
    # One row per bucket, so at most BUCKETS rows are broadcast at any scale.
    numbered = placed.withColumn("_in", F.row_number().over(order)).join(F.broadcast(counts), "_bucket")
    numbered = numbered.withColumn("_at", F.col("_before") + F.col("_in") - 1)
    number = F.expr(f"(_at * {shards}) div _rows")
    first = F.expr(f"(_shard * _rows + {shards - 1}) div {shards}")
    return numbered.withColumn("_shard", number).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_at") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
