"""The link graph (JOI-1, JOI-4, SET-2, TOP-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.operators.skew import spread_join


def links_of_site(links: DataFrame, pages: DataFrame, sites: DataFrame, domain: str) -> DataFrame:
    """Every link that starts on a page of ``domain``, with both URLs.

    The site filter goes first: only pages of that site meet the edges, and only
    their edges look up a target, which may be one page for all of them.
    """
    of_site = sites.where(F.col("domain") == domain).select(F.col("id").alias("site_id"))
    sources = pages.select(F.col("id").alias("from_page"), "site_id", F.col("url").alias("source"))
    starting = spread_join(links, sources.join(of_site, "site_id"), ["from_page"], "inner", ["to_page"]).drop("site_id")
    targets = pages.select(F.col("id").alias("to_page"), F.col("url").alias("target"))
    return spread_join(starting, targets, ["to_page"], "inner", ["from_page"]).select(
        "from_page", "to_page", "source", "target"
    )


def limit_links(links: DataFrame, n: int) -> DataFrame:
    """The first ``n`` links by (from, to); a limit alone would pick any rows."""
    return links.orderBy("from_page", "to_page").limit(n)


def links_of_domain(
    links: DataFrame, pages: DataFrame, sites: DataFrame, domain: str, limit: int | None = None
) -> DataFrame:
    """All links of a domain, or the first ``limit`` of them by (from, to)."""
    found = links_of_site(links, pages, sites, domain)
    return found if limit is None else limit_links(found, limit)


def new_links(edges: DataFrame, links: DataFrame, buckets: int | None = None) -> DataFrame:
    """Distinct edges that are not stored yet; self-loops are legal.

    Where ``links`` is a table of ``buckets`` buckets by both pages, only the edges are moved.
    """
    key = ["from_page", "to_page"]
    if buckets is not None:
        edges, links = edges.select(*key).repartition(buckets, *key), links.hint("merge")
    return edges.select(*key).distinct().join(links.select(*key), key, "left_anti")


def graph_nodes(edges: DataFrame, source: str = "from_page", target: str = "to_page") -> DataFrame:
    """Distinct sources and targets."""
    return edges.select(F.col(source).alias("node")).union(edges.select(F.col(target).alias("node"))).distinct()
