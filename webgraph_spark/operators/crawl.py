"""Fetch results: classification and page updates (CLS-1, CLS-3..5, AGG-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions import responses, shingles


def classify_response(fetches: DataFrame) -> DataFrame:
    """Adds type, stored status and what is kept of each fetch.

    fetches has page_id, site_id, accessed_time, robots_ok, error, status,
    content_type, html (the rendered page, NULL when rendering failed) and
    duplicate.
    """
    typed = fetches.withColumn(
        "page_type_code",
        responses.page_type(
            F.col("robots_ok"),
            F.col("error"),
            F.col("status"),
            F.col("content_type"),
            F.col("html").isNotNull(),
            F.col("duplicate"),
        ),
    )
    kind = F.col("page_type_code")
    return typed.select(
        "page_id",
        "site_id",
        "page_type_code",
        responses.stored_status(kind, F.col("status")).alias("http_status_code"),
        F.when(kind == "HTML", F.col("html")).alias("html_content"),
        F.when(kind.isin("HTML", "DUPLICATE"), shingles.content_hash(F.col("html"))).alias("hash_content"),
        F.when(kind == "BINARY", responses.data_type_code(F.col("content_type"))).alias("data_type_code"),
        "accessed_time",
    )


def crawl_result(pages: DataFrame, results: DataFrame) -> DataFrame:
    """The page table with this batch's results (one per page) written in.

    Only queued pages are fetched, and they hold no markup yet. So only their
    rows meet the results; stored pages pass by without a shuffle.
    """
    kind = F.col("page_type_code")
    renamed = results.select(
        F.col("page_id").alias("id"),
        F.struct(
            "site_id", "page_type_code", "html_content", "hash_content", "http_status_code", "accessed_time"
        ).alias("_result"),
    )
    crawled = F.col("_result").isNotNull()

    def updated(name: str):
        return F.when(crawled, F.col(f"_result.{name}")).otherwise(F.col(name)).alias(name)

    written = {"site_id", "page_type_code", "html_content", "hash_content", "http_status_code", "accessed_time"}
    columns = []
    for name in pages.columns:
        if name in written:
            columns.append(updated(name))
        elif name == "active_in_crawler":
            columns.append(F.when(~crawled, F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    fetched = pages.where(kind == "FRONTIER").join(renamed, "id", "left").select(*columns)
    return pages.where((kind != "FRONTIER") | kind.isNull()).unionByName(fetched)


def site_last_crawled(fetches: DataFrame) -> DataFrame:
    """Last time any page of the site was finished."""
    return fetches.where("site_id is not null").groupBy("site_id").agg(F.max("accessed_time").alias("last_crawled_at"))


def update_sites(sites: DataFrame, fetches: DataFrame) -> DataFrame:
    """The site table with last_crawled_at moved on for the sites of this batch, never back."""
    latest = site_last_crawled(fetches).select(F.col("site_id").alias("id"), F.col("last_crawled_at").alias("_latest"))
    joined = sites.join(latest, "id", "left")
    return joined.withColumn("last_crawled_at", F.greatest("_latest", "last_crawled_at")).drop("_latest")


def reset_active(pages: DataFrame) -> DataFrame:
    """Frees every page that is still queued, as at a restart."""
    waiting = F.coalesce(F.col("page_type_code") == "FRONTIER", F.lit(False))
    return pages.withColumn("active_in_crawler", F.when(~waiting, F.col("active_in_crawler")))


def return_to_frontier(pages: DataFrame, ids: DataFrame) -> DataFrame:
    """Frees the listed pages (ids has id)."""
    listed = ids.select("id").distinct().withColumn("_listed", F.lit(True))
    joined = pages.join(listed, "id", "left")
    freed = F.when(F.col("_listed").isNull(), F.col("active_in_crawler"))
    return joined.withColumn("active_in_crawler", freed).drop("_listed")
