"""One crawl round as a set-based job: fetched pages in, new table rows out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions import shingles
from webgraph_spark.operators import crawl, duplicates, extract, frontier, links
from webgraph_spark.schemas import LIMITS, Limits
from webgraph_spark.session import cut_lineage


@dataclass
class Round:
    """What a round leaves to be stored."""

    results: DataFrame
    signatures: DataFrame
    hashes: DataFrame
    created: DataFrame
    edges: DataFrame


def crawl_round(
    fetches: DataFrame,
    pages: DataFrame,
    stored_links: DataFrame,
    limits: Limits = LIMITS,
    stored_hashes: DataFrame | None = None,
    stored_signatures: DataFrame | None = None,
) -> Round:
    """Classify, mark duplicates, extract, admit and link the fetches of one round.

    fetches is the fetch log plus robots_ok and ord (order of arrival); pages,
    stored_links, stored_hashes and stored_signatures are the tables before the round. Pages are
    compared with those of earlier rounds through the last two.
    """
    readable = (
        F.col("robots_ok")
        & F.col("error").isNull()
        & (F.col("status") < 400)
        & F.col("content_type").contains("text/html")
        & F.col("html").isNotNull()
    )
    html_pages = fetches.where(readable).select(F.col("page_id").alias("id"), "ord", F.col("html").alias("html_content"))
    marked = duplicates.mark_duplicates(
        html_pages,
        limits.max_similarity,
        limits.shingle_words,
        stored_hashes=stored_hashes,
        stored_signatures=stored_signatures,
    )
    marks = cut_lineage(marked, "marks")
    flags = marks.select(F.col("id").alias("page_id"), (F.col("status") != "kept").alias("duplicate"))
    results = crawl.classify_response(fetches.join(flags, "page_id", "left"))

    kept = fetches.where(readable).join(marks.where("status = 'kept'").select(F.col("id").alias("page_id")), "page_id")
    kept_pages = kept.select(F.col("page_id").alias("id"), "ord", "url", F.col("html").alias("html_content"))
    found = extract.all_candidates(
        extract.extract_links(kept_pages),
        extract.extract_images(kept_pages),
        extract.extract_script_links(kept_pages),
    )
    candidates = cut_lineage(extract.admissible(found, limits.scope, limits.max_url_length), "candidates")
    admitted = candidates if limits.max_page_rows is None else frontier.row_cap(candidates, pages, limits.max_page_rows)
    created, edges = frontier.resolve_candidates(admitted, pages)
    return Round(
        results=results,
        signatures=duplicates.page_signatures(kept_pages, limits.shingle_words).where("hash_length > 0"),
        hashes=html_pages.select("id", "ord", shingles.content_hash(F.col("html_content")).alias("hash_content")),
        created=created,
        edges=links.new_links(edges, stored_links),
    )
