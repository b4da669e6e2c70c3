"""The crawl frontier: queue, admission of candidates, page ids (FLT-3, TOP-1, TOP-2, GAT-1, JOI-2, JOI-3, SET-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.functions import urls
from webgraph_spark.operators.ordering import number_rows
from webgraph_spark.operators.skew import spread_join
from webgraph_spark.schemas import LIMITS
from webgraph_spark.session import cut_lineage


def frontier_ready(pages: DataFrame) -> DataFrame:
    """Pages that wait and that no worker has taken ("free" is NULL, not FALSE)."""
    return pages.where((F.col("page_type_code") == "FRONTIER") & F.col("active_in_crawler").isNull())


def _oldest_first() -> list:
    return [F.asc_nulls_last("added_at_time"), F.asc("id")]


def next_from_frontier(pages: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` oldest ready pages, marked active, with their URL percent-decoded."""
    batch = frontier_ready(pages).orderBy(*_oldest_first()).limit(n)
    return batch.withColumn("active_in_crawler", F.lit(True)).withColumn("url", urls.percent_decode(F.col("url")))


def next_per_site(pages: DataFrame, k: int) -> DataFrame:
    """The ``k`` oldest ready pages of every site.

    Spark cuts each task's rows to ``k`` per site before the shuffle, so a site
    with a third of the queue does not end up in one task.
    """
    ready = frontier_ready(pages).withColumn("site", urls.origin(F.col("url")))
    place = F.row_number().over(Window.partitionBy("site").orderBy(*_oldest_first()))
    batch = ready.withColumn("place", place).where(F.col("place") <= k)
    return batch.withColumn("active_in_crawler", F.lit(True)).withColumn("url", urls.percent_decode(F.col("url")))


def admit_unique(
    new: DataFrame, existing: DataFrame, key: Sequence[str], order: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, the first by ``order`` per key.

    Where ``existing`` is a table of ``buckets`` buckets by ``key``, ``new`` is dealt the same way and the stored rows stay in place.
    """
    key = list(key)
    if buckets is not None:
        new, existing = new.repartition(buckets, *key), existing.hint("merge")
    rest = [name for name in new.columns if name not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.lit(None)
    firsts = new.groupBy(*key).agg(first.alias("_first"))
    absent = firsts.join(existing.select(*key), key, "left_anti")
    return absent.select(*[name if name in key else F.col(f"_first.{name}").alias(name) for name in new.columns])


def page_count(pages: DataFrame) -> DataFrame:
    """AGG-1: number of pages."""
    return pages.agg(F.count("id").alias("pages"))


def row_cap(candidates: DataFrame, pages: DataFrame, cap: int) -> DataFrame:
    """The whole batch, or nothing once the page table holds more than ``cap`` rows."""
    return candidates.where(page_count(pages).scalar() <= cap)


def missing_sites(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Origins of pages that no site row has, numbered on from the largest site id."""
    seen = pages.select(urls.origin(F.col("url")).alias("domain"), F.col("id").alias("first_page"))
    new = admit_unique(seen, sites, ["domain"], ["first_page"])
    last = sites.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    return number_rows(new, ["first_page", "domain"], "_place").select((last + F.col("_place")).alias("id"), "domain")


def pages_with_site(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Adds site_id by origin, NULL when the site is not known yet."""
    located = pages.withColumn("domain", urls.origin(F.col("url")))
    known = sites.select("domain", F.col("id").alias("site_id"))
    return spread_join(located, known, ["domain"], "left", ["id"])


def new_pages(candidates: DataFrame, pages: DataFrame, buckets: int | None = None) -> DataFrame:
    """FRONTIER rows (id, url) for target URLs without a page, numbered by first sight.

    ``buckets``: of ``pages``, a table stored in buckets by url.
    """
    firsts = candidates.select(F.col("to_url").alias("url"), "from_page", "pos")
    absent = admit_unique(firsts, pages, ["url"], ["from_page", "pos"], buckets)
    last = pages.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    numbered = number_rows(absent, ["from_page", "pos", "url"], "_place")
    return numbered.select((last + F.col("_place")).alias("id"), "url")


def resolve_candidates(candidates: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New frontier pages (id, url) and the distinct edges (from_page, to_page).

    candidates has from_page, to_url, pos; pages has id, url. An existing page
    wins; otherwise the URL gets a new one.
    """
    # Read several times below; the markup it comes from should be read once.
    candidates = cut_lineage(candidates.select("from_page", "to_url", "pos"), "candidates")
    created = new_pages(candidates, pages)
    wanted = candidates.select("from_page", F.col("to_url").alias("url")).distinct()
    ids = pages.select("url", F.col("id").alias("to_page")).unionByName(
        created.select("url", F.col("id").alias("to_page"))
    )
    edges = spread_join(wanted, ids, ["url"], "inner", ["from_page"])
    return created, edges.select("from_page", "to_page")


def frontier_rows(created: DataFrame, added_at) -> DataFrame:
    """Page rows for new URLs as they enter the queue."""
    return created.select(
        "id",
        "url",
        F.lit("FRONTIER").alias("page_type_code"),
        added_at.alias("added_at_time"),
        F.lit(None).cast("boolean").alias("active_in_crawler"),
    )
