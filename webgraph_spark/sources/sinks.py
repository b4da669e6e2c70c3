"""Report files (SNK-1, SNK-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.schemas import LIMITS


def _page_json(size: int) -> Column:
    leaf = F.struct(
        F.col("url").alias("name"),
        F.col("page_type_code").alias("type"),
        F.lit(size).alias("size"),
        F.array().cast("array<string>").alias("children"),
    )
    return F.to_json(leaf, {"ignoreNullFields": "false"})


def site_tree_lines(sites: DataFrame, pages: DataFrame, size: int = LIMITS.page_size_units) -> DataFrame:
    """The lines (place, kind, page, value) of the nested report; in that order they are one JSON document.

    No row holds a list, so a site with any number of pages is only more lines.
    """
    firsts = pages.groupBy("site_id").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("first"))
    first_site = sites.agg(F.min("id")).scalar()
    of_site = sites.select(F.col("id").alias("place"), F.to_json(F.struct(F.col("domain").alias("name"))).alias("head"))

    def line(place: Column, kind: int, page: Column, value: Column) -> list[Column]:
        return [place.alias("place"), F.lit(kind).alias("kind"), page.cast("bigint").alias("page"), value.alias("value")]

    none = F.lit(None)
    comma = F.when(F.col("place") == first_site, "").otherwise(",")
    opening = of_site.select(
        *line(F.col("place"), 1, none, F.concat(comma, F.expr("left(head, length(head) - 1)"), F.lit(',"children":[')))
    )
    closing = of_site.select(*line(F.col("place"), 3, none, F.lit("]}")))
    known = pages.join(of_site.select(F.col("place").alias("site_id")), "site_id", "left_semi")
    leaves = known.join(firsts, "id", "left").select(
        *line(F.col("site_id"), 2, F.col("id"), F.concat(F.when(F.col("first"), "").otherwise(","), _page_json(size)))
    )
    spark = sites.sparkSession
    ends = spark.createDataFrame(
        [(-(2**63), 0, None, '{"name":"Sites","children":['), (2**63 - 1, 4, None, "]}")],
        "place bigint, kind int, page bigint, value string",
    )
    return ends.union(opening).union(leaves).union(closing)


def write_site_tree(sites: DataFrame, pages: DataFrame, path: str) -> None:
    """The report as text; its part files, put together in name order, are one JSON document."""
    order = ["place", "kind", "page"]
    lines = site_tree_lines(sites, pages)
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.text(path)


def write_link_edges(edges: DataFrame, path: str) -> None:
    """One JSON object {source, target, weight, type} per line."""
    edges.select("source", "target", "weight", "type").write.json(path)
