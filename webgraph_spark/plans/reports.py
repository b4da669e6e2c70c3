"""Reports over the crawl tables (AGG-5, AGG-6, TOP-4, RPT-1..4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions import responses
from webgraph_spark.operators.links import links_of_domain
from webgraph_spark.operators.skew import spread_join
from webgraph_spark.schemas import LIMITS

# Children that one row of the nested report holds at most, on average.
CHILDREN_PER_ROW = 10_000


def site_tree(
    sites: DataFrame,
    pages: DataFrame,
    size: int = LIMITS.page_size_units,
    children_per_row: int = CHILDREN_PER_ROW,
) -> DataFrame:
    """(site_id, name, part, children): sites with their pages; sites without pages keep an empty list.

    A site with more than ``children_per_row`` pages goes over several rows, so
    no group grows with the site; the parts of a site together are its list.
    """
    counts = pages.where("site_id is not null").groupBy("site_id").agg(F.count(F.lit(1)).alias("_pages"))
    parts = counts.select("site_id", F.ceil(F.col("_pages") / children_per_row).cast("int").alias("_split"))
    leaves = spread_join(
        pages.select("id", "site_id", "url", "page_type_code"),
        parts,
        ["site_id"],
        "inner",
        ["id"],
        counts=counts,
        rows="_pages",
    )
    leaf = F.struct(
        F.col("id"),
        F.col("url").alias("name"),
        F.col("page_type_code").alias("type"),
        F.lit(size).alias("size"),
        F.array().cast("array<string>").alias("children"),
    )
    lists = leaves.groupBy("site_id", F.pmod(F.xxhash64("id"), F.col("_split")).cast("int").alias("part")).agg(
        F.array_sort(F.collect_list(leaf)).alias("children")
    )
    empty = F.array().cast(lists.schema["children"].dataType)
    named = sites.select(F.col("id").alias("site_id"), F.col("domain").alias("name"))
    joined = named.join(lists, "site_id", "left")
    return joined.select(
        "site_id", "name", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("children", empty).alias("children")
    )


def site_page_tree(sites: DataFrame, pages: DataFrame, **options) -> DataFrame:
    """RPT-1: the nested rows as (site_id, part, json)."""
    tree = site_tree(sites, pages, **options)
    children = F.transform("children", lambda c: c.dropFields("id"))
    node = F.struct("name", children.alias("children"))
    return tree.select("site_id", "part", F.to_json(node, {"ignoreNullFields": "false"}).alias("json"))


def tree_size_rollup(sites: DataFrame, pages: DataFrame, size: int = LIMITS.page_size_units) -> DataFrame:
    """(domain, url, level, size): sums of leaf sizes for pages (0), sites (1) and the root (3).

    Pages are counted per site and URL before the site names are joined.
    """
    counted = pages.where("site_id is not null").groupBy("site_id", "url").agg(F.sum(F.lit(size)).alias("size"))
    named = spread_join(
        counted, sites.select(F.col("id").alias("site_id"), "domain"), ["site_id"], "inner", ["url"]
    )
    return named.rollup("domain", "url").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("size").alias("size")
    )


def tree_order(nodes: DataFrame) -> DataFrame:
    """Nodes of a level by size, largest first, ties by name."""
    return nodes.orderBy(F.desc("size"), F.asc("domain"), F.asc("url"))


def type_counts_by_site(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """RPT-3: pages per site and type with the legend's colour."""
    counted = pages.where("site_id is not null").groupBy("site_id", "page_type_code").agg(F.count(F.lit(1)).alias("pages"))
    named = counted.join(sites.select(F.col("id").alias("site_id"), "domain"), "site_id")
    return named.select("domain", "page_type_code", responses.type_colour(F.col("page_type_code")).alias("colour"), "pages")


def domain_link_report(
    links: DataFrame,
    pages: DataFrame,
    sites: DataFrame,
    domain: str = LIMITS.report_domain,
    limit: int | None = None,
) -> DataFrame:
    """RPT-2: (source, target, weight, type) of the links that start on a domain."""
    return links_of_domain(links, pages, sites, domain, limit).select(
        "source", "target", F.lit(1).alias("weight"), F.lit("").alias("type")
    )


def report_pages(pages: DataFrame, n: int) -> DataFrame:
    """RPT-4: the first ``n`` pages by id, as many as the page figure holds."""
    return pages.orderBy("id").limit(n)
