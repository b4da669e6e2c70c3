"""Rows of what a fetch brings besides markup: images, documents, sites with their files (SNK-3, WIN-3, JOI-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions import responses, urls
from webgraph_spark.operators.budget import byte_budget
from webgraph_spark.operators.robots import robots_file_usable
from webgraph_spark.schemas import LIMITS


def _typed(fetches: DataFrame, kind: str) -> DataFrame:
    page_type = responses.page_type(
        F.col("robots_ok"), F.col("error"), F.col("status"), F.col("content_type"), F.col("html").isNotNull(), F.lit(False)
    )
    return fetches.where((page_type == kind) & F.col("body").isNotNull())


def _size() -> Column:
    return F.octet_length("body").cast("long").alias("data_size")


def _within(rows: DataFrame, order: Sequence[str], limit: int, stored: int) -> DataFrame:
    return byte_budget(rows, order, limit, stored).where("admitted").drop("admitted", *order)


def image_rows(
    fetches: DataFrame, order: Sequence[str] = ("_ord",), limit: int = LIMITS.max_stored_bytes, stored: int = 0
) -> DataFrame:
    """Rows of ``image`` for fetched images, as far as the byte budget goes.

    fetches is the fetch log plus robots_ok and the ``order`` of arrival, columns of other names than those of ``image``.
    A size is the number of bytes of the body; fetches without a body give no row.
    """
    rows = _typed(fetches, "IMAGE").select(
        *order, "page_id", urls.image_filename(F.col("url")).alias("filename"), "content_type", F.col("body").alias("data"), _size(), "accessed_time"
    )
    return _within(rows, order, limit, stored)


def page_data_rows(
    fetches: DataFrame, order: Sequence[str] = ("_ord",), limit: int = LIMITS.max_stored_bytes, stored: int = 0
) -> DataFrame:
    """Rows of ``page_data`` for fetched documents of a known type, as far as the byte budget goes; fetches as above."""
    code = responses.data_type_code(F.col("content_type"))
    rows = _typed(fetches, "BINARY").select(*order, "page_id", code.alias("data_type_code"), F.col("body").alias("data"), _size())
    return _within(rows.where("data_type_code is not null"), order, limit, stored)


def site_rows(sites: DataFrame, robots_files: DataFrame, sitemap_files: DataFrame | None = None) -> DataFrame:
    """Rows of ``site`` (id, domain, robots_content, sitemap_content) for new sites (id, domain).

    robots_files has domain, status, content_type, body (text), one per site; a file that does not count is NULL.
    sitemap_files has domain, pos, status, body: what the site's robots file lists, in order. The last one is kept, and
    is NULL if it was not found, whatever came before it.
    """
    texts = robots_file_usable(robots_files).select("domain", F.col("body").alias("robots_content"))
    joined = sites.select("id", "domain").join(texts, "domain", "left")
    if sitemap_files is None:
        return joined.select("id", "domain", "robots_content", F.lit(None).cast("string").alias("sitemap_content"))
    # The body is not aggregated: a site with many large sitemaps keeps only its last place, then its one body.
    last = sitemap_files.groupBy("domain").agg(F.max("pos").alias("pos"))
    found = sitemap_files.where(F.col("status") == 200).select("domain", "pos", F.col("body").alias("sitemap_content"))
    kept = last.join(found, ["domain", "pos"], "left").select("domain", "sitemap_content")
    return joined.join(kept, "domain", "left").select("id", "domain", "robots_content", "sitemap_content")
