"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.session import cut_lineage, drop_tables


def _towards_least(links: DataFrame, small: bool) -> DataFrame:
    """One round. Every vertex ties its larger neighbours (``small``: its smaller ones and itself) to the
    smallest vertex it knows. The smallest is a map-side minimum; a vertex of many links meets one row."""
    if small:
        seen = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        seen = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = seen.groupBy("u").agg(F.min("v").alias("_least")).select("u", F.least("u", "_least").alias("m"))
    met = seen.join(least, "u")
    if small:
        tied = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        tied = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``links`` (a, b): the smallest vertex reachable.

    Links go either way and may repeat. Rounds end when the links no longer change, after a number of rounds that grows
    with the logarithm of the longest chain. Vertices without links do not appear.
    """
    links = cut_lineage(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        mark = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
        last, links = links, cut_lineage(_towards_least(_towards_least(links, small=False), small=True), "links")
        drop_tables(last)
    ties = links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return ties.union(roots)
