"""Crawl tables on storage: scans, lookups, appends (SRC-2..6, SNK-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webgraph_spark.operators.frontier import admit_unique
from webgraph_spark.schemas import TABLES

# What makes a row of a table unique.
UNIQUE_KEYS = {"site": ["domain"], "page": ["url"], "link": ["from_page", "to_page"]}


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(table_path(base, table))


def scan_sites(sites: DataFrame) -> DataFrame:
    return sites.select([c for c in TABLES["site"].names if c in sites.columns])


def scan_links(links: DataFrame) -> DataFrame:
    return links.select("from_page", "to_page")


def scan_crawled_pages(pages: DataFrame) -> DataFrame:
    """Pages that left the queue; a NULL type is neither in nor out of it and drops out."""
    return pages.where(~(F.col("page_type_code") == "FRONTIER"))


def pages_by_site(pages: DataFrame, site_id: int) -> DataFrame:
    return pages.where(F.col("site_id") == site_id)


def site_by_domain(sites: DataFrame, domains: DataFrame) -> DataFrame:
    """Site rows for a table of domains, as one join instead of a lookup each."""
    return domains.select("domain").distinct().join(
        sites.select("id", "domain", "robots_content", "last_crawled_at"), "domain"
    )


def append(df: DataFrame, base: str, table: str) -> None:
    """Adds rows to a stored table; columns follow its schema, missing ones are NULL."""
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[table]
    ]
    df.select(columns).write.mode("append").parquet(table_path(base, table))


def append_new(df: DataFrame, stored: DataFrame, base: str, table: str, order: list[str]) -> None:
    """Adds the rows whose key is not stored yet; a second run of the same batch adds none."""
    append(admit_unique(df, stored, UNIQUE_KEYS[table], order), base, table)
