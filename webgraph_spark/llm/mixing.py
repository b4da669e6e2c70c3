"""Mixing sources to target weights by hash-threshold histograms.

Words are summed by source and by a bucket of a seeded row hash. A running sum over
the buckets of a source says in which bucket its budget ends; only that bucket is
refined, by the next digits of the hash, and so on. What is left is one
threshold per source, which a filter applies to rows: nothing is sorted.

Budgets are nested: a source with a target of 1.4 times its size takes all rows once
and those below its threshold twice; a larger target only ever adds rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.llm.common import same, whole_text, word_count
from webgraph_spark.session import cut_lineage

# Hex digits of the hash per refinement: 4,096 buckets each, so a source has at most
# that many rows in any histogram. Three steps leave one in 7e10 of a source undivided.
DIGITS = 3
STEPS = 3

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def row_hash(seed: str, doc_id: Column, text: Column) -> Column:
    """The first ``DIGITS * STEPS`` hex digits of a hash of seed, id and text."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), whole_text(text)).cast("binary"))
    return F.substring(digest, 1, DIGITS * STEPS)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources in code point order, NULL last, get ``weights`` in turn and share ``share``
    times all sizes. A target stops at ``most`` times the size of its source and what it
    leaves goes to the others by weight. All targets that are not at their stop stay in
    proportion to the weights, so one level fixes them: sources are ordered by
    stop / weight, and the level is the first one that its own source can take.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    weighed = sizes.withColumn("_weight", weight).withColumn("_stop", F.col("source_size") * most)
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("_stop") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (
        weighed.withColumn("_at", F.row_number().over(order))
        .withColumn("_budget", F.sum("source_size").over(everything) * share)
        .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_stop").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.sum("_weight").over(onward))
    )
    fits = F.col("_level") * F.col("_weight") <= F.col("_stop")
    first = F.min(F.when(fits, F.struct(F.col("_at"), F.col("_level").alias("level"))))
    level = first.over(everything)["level"]
    target = F.least("_stop", F.coalesce(level * F.col("_weight"), F.col("_stop")))
    return levels.withColumn("target", target).select("source", "source_size", "target")


def _refine(rows: DataFrame, cuts: DataFrame, step: int) -> DataFrame:
    """One more step of digits on ``cuts`` (source, cut, left): the bucket where ``left`` ends, and what is left in it."""
    bucket = F.substring("hash", step * DIGITS + 1, DIGITS)
    inside = rows if step == 0 else same(rows, cuts.select("source", "cut"), ["source"], "inner").where(
        F.substring("hash", 1, step * DIGITS) == F.col("cut")
    )
    sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = same(sums.withColumn("upto", F.sum("words").over(upto)), cuts.select("source", "cut", "left"), ["source"], "inner")
    crossing = running.where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
    return crossing.select(
        "source",
        F.concat("cut", "bucket").alias("cut"),
        (F.col("left") - (F.col("upto") - F.col("words"))).alias("left"),
        "words",
    )


def plan(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target, whole, cut, cut_too): the thresholds, one row per source.

    ``sized`` has (source, size, hash). Every row of a source is taken ``whole`` times,
    and once more if its hash is below ``cut`` (or equal, with ``cut_too``).
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = cut_lineage(targets.withColumn("whole", whole), "mix-targets")
    left = F.col("target") - F.col("whole") * F.col("source_size")
    cuts = targets.select("source", F.lit("").alias("cut"), left.alias("left"))
    for step in range(STEPS):
        cuts = cut_lineage(_refine(sized, cuts, step), "mix-cuts")
    last = cuts.select("source", "cut", (F.col("left") * 2 >= F.col("words")).alias("cut_too"))
    return same(targets, last, ["source"])


def times(planned: DataFrame) -> Column:
    """How often a row joined with its source's plan is taken."""
    more = (F.col("hash") < F.col("cut")) | ((F.col("hash") == F.col("cut")) & F.col("cut_too"))
    return (F.col("whole") + F.coalesce(more, F.lit(False)).cast("int")).cast("long")


def mix(docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target, times and taken = times * size.

    A NULL text has size 0; a NULL source is a source of its own, the last one. Rows
    equal in id and text have one hash and are decided together. An empty table
    gives an empty table. Sizes are counted once and kept in a narrow table; the rows
    meet only one plan row per source. Other columns of ``docs`` are kept, but for
    those with the names of the added ones, which are replaced.
    """
    sized = docs.withColumns(
        {"size": word_count(whole_text()), "hash": row_hash(seed, F.col("doc_id"), F.col("text"))}
    )
    narrow = cut_lineage(sized.select("source", "size", "hash"), "mix-sizes")
    planned = plan(narrow, weights, share, most)
    clash = ["source_size", "target", "whole", "cut", "cut_too"]
    joined = same(sized.drop(*clash), planned, ["source"])
    return (
        joined.withColumn("times", times(joined))
        .withColumn("taken", F.col("times") * F.col("size"))
        .drop("whole", "cut", "cut_too", "hash")
    )


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, same columns."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "doc_id", "text", "source")
    mixed = mix(rows, **options)
    copies = mixed.where("times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_copy"))
    return copies.select("_row.*")
