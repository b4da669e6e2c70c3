"""Crawl delay audit and schedule (WIN-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.operators.ordering import RANGE, in_ranges
from webgraph_spark.operators.skew import spread_join


def _exact_seconds(interval: Column) -> Column:
    # Times have no zone, so the difference is taken from the interval and never through a zone.
    units = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    total = F.lit(0).cast("decimal(20,6)")
    for unit, seconds in units.items():
        total = total + F.extract(F.lit(unit), interval).cast("decimal(12,6)") * seconds
    return total


def _seconds(interval: Column) -> Column:
    return _exact_seconds(interval).cast("double")


def previous_fetch(fetches: DataFrame) -> DataFrame:
    """Adds last_crawled_at, the fetch of the same site before this one.

    fetches has page_id, site_id, accessed_time. One site may hold any share of
    the rows, so rows are cut into ranges of (site, time, id); the first row of
    a site in a range takes the last fetch of the range before.
    """
    order = ["site_id", "accessed_time", "page_id"]
    ranged = in_ranges(fetches.select(*order), order)
    part = [RANGE, "site_id"]
    inside = F.lag("accessed_time").over(Window.partitionBy(*part).orderBy("accessed_time", "page_id"))
    last = ranged.groupBy(*part).agg(F.max("accessed_time").alias("_last"))
    carried = last.select(*part, F.lag("_last").over(Window.partitionBy("site_id").orderBy(RANGE)).alias("_carried"))
    return (
        ranged.withColumn("_inside", inside)
        .join(carried, part, "left")
        .select(*order, F.coalesce("_inside", "_carried").alias("last_crawled_at"))
    )


def politeness_audit(fetches: DataFrame, delays: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """Per fetch the gap to the site's last fetch, whether it broke the delay, and the waits.

    Rows with ``robots_ok`` false made no request and are left out. ``sites`` (id, last_crawled_at) says when a
    site was last fetched before the first of its rows here.
    delays has site_id, crawl_delay (seconds, NULL for none). ``wait`` is what
    was left of the delay; ``slept`` is the whole delay, which is what a worker
    that comes too early sleeps.
    """
    if "robots_ok" in fetches.columns:
        fetches = fetches.where(F.coalesce("robots_ok", F.lit(True)))
    timed = spread_join(previous_fetch(fetches), delays, ["site_id"], "left", ["page_id"])
    if sites is not None:
        before = sites.select(F.col("id").alias("site_id"), F.col("last_crawled_at").alias("_stored"))
        timed = spread_join(timed, before, ["site_id"], "left", ["page_id"])
        timed = timed.withColumn("last_crawled_at", F.coalesce("last_crawled_at", "_stored")).drop("_stored")
    gap = _seconds(F.col("accessed_time") - F.col("last_crawled_at"))
    left = F.col("crawl_delay") - F.col("gap")
    early = F.coalesce(left > 0, F.lit(False))
    return timed.withColumn("gap", gap).select(
        "page_id",
        "site_id",
        "accessed_time",
        "last_crawled_at",
        "crawl_delay",
        "gap",
        early.alias("violation"),
        F.when(early, left).otherwise(F.lit(0.0)).alias("wait"),
        F.when(early, F.col("crawl_delay")).otherwise(F.lit(0)).cast("int").alias("slept"),
    )


def politeness_schedule(fetches: DataFrame, delays: DataFrame) -> DataFrame:
    """(page_id, site_id, wait): how many microseconds each fetch has to be put off, were every delay kept.

    A fetch starts at its time, or one delay after the start of the site's fetch before, whichever is later:
    start(i) = max(time(i), start(i - 1) + delay), which is i * delay + the greatest time(j) - j * delay of j <= i. Sites are cut
    into ranges; inside, that is a running maximum, and a range takes one number from those before. So a site of a third
    of all fetches is no single task. Sites without a delay wait for nothing; rows without a site or time have no wait.
    """
    order = ["site_id", "accessed_time", "page_id"]
    known = delays.select("site_id", F.coalesce("crawl_delay", F.lit(0)).alias("delay"))
    timed = spread_join(fetches.select(*order), known, ["site_id"], "left", ["page_id"])
    epoch = F.lit("1970-01-01 00:00:00").cast(fetches.schema["accessed_time"].dataType)
    micros = (_exact_seconds(F.col("accessed_time") - epoch) * 1_000_000).cast("long")
    delay = F.coalesce("delay", F.lit(0)).cast("long") * 1_000_000
    ranged = in_ranges(timed.select(*order, micros.alias("at"), delay.alias("delay")), order)
    inside = Window.partitionBy(RANGE, "site_id").orderBy("accessed_time", "page_id")
    placed = ranged.withColumn("i", F.row_number().over(inside))
    placed = placed.withColumn("most", F.max(F.col("at") - F.col("i") * F.col("delay")).over(inside))
    # One row per range and site: sites and ranges together bound them.
    parts = placed.groupBy(RANGE, "site_id").agg(F.count(F.lit(1)).alias("n"), F.max("most").alias("most"), F.max("delay").alias("d"))
    earlier = Window.partitionBy("site_id").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    carried = F.max(F.col("most") - F.col("offset") * F.col("d")).over(earlier)
    parts = parts.select(RANGE, "site_id", "offset", carried.alias("carried"))
    joined = placed.join(parts, [RANGE, "site_id"])
    shift = F.col("offset") * F.col("delay")
    start = F.greatest(F.col("carried"), F.col("most") - shift) + shift + F.col("i") * F.col("delay")
    return joined.select("page_id", "site_id", (start - F.col("at")).alias("wait"))
