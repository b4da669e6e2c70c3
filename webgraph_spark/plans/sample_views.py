"""Crawl tables derived from the given parquet tables, for queries and benchmarks.

Every view is a plain projection or aggregate of a whole table, so its size
grows with the table. The same definitions are written as SQL in the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgraph_spark.functions import urls
from webgraph_spark.operators import extract
from webgraph_spark.operators.skew import spread_join
from webgraph_spark.schemas import PAGE_TYPES

# Robots texts of sample sites by id modulo 8; {d} is the site.
ROBOTS_TEXTS = [
    "User-agent: *\nDisallow: /fr\nAllow: /fr/8\nCrawl-delay: 5\nSitemap: {d}sitemap.xml",
    "User-agent: *\nAllow: /en/4 # some\nDisallow: /en\nrequest-rate: 1/5",
    "# note\nUser-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /de\nDisallow: /es\nCrawl-delay: 0.5",
    "User-agent: *\n\nDisallow: /",
    "User-agent: *\nDisallow:\nCrawl-delay: 12\n\nUser-agent: *\nDisallow: /",
    "Disallow: /\nSitemap: {d}a.xml\nUser-agent: *\nCrawl-delay: 7\nSitemap: {d}b.xml",
    "User-agent: a\nUser-agent: *\nDisallow: /*.html$\nDisallow: /en/7",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when there are fewer files than cores.

    The given tables are one file each, which one task would read and parse
    alone. A table of many files stays as it is: no shuffle of page bodies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def _at(seconds: Column) -> Column:
    return F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ord, url, html_content) of every page."""
    return spread(table(spark, sf_dir, "pages")).select(
        F.col("page_id").alias("id"), F.col("page_id").alias("ord"), "url", F.col("html").alias("html_content")
    )


def robots_text(site_id: Column, domain: Column) -> Column:
    text = F.lit(None).cast("string")
    for rest, content in enumerate(ROBOTS_TEXTS):
        text = F.when(site_id % 8 == rest, F.replace(F.lit(content), F.lit("{d}"), domain)).otherwise(text)
    return text


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, domain, robots_content, last_crawled_at): one row per origin, id = its first page."""
    located = table(spark, sf_dir, "pages").select("page_id", urls.origin(F.col("url")).alias("domain"))
    firsts = located.groupBy("domain").agg(F.min("page_id").alias("id"))
    return firsts.select(
        "id",
        "domain",
        robots_text(F.col("id"), F.col("domain")).alias("robots_content"),
        F.lit(None).cast("timestamp_ntz").alias("last_crawled_at"),
    )


def page_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page rows in every state: type, queue flag and time by id, site_id unless queued."""
    page = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    typed = (
        page.withColumn("domain", urls.origin(F.col("url")))
        .withColumn(
            "page_type_code",
            F.element_at(F.array(*[F.lit(c) for c in PAGE_TYPES]), (F.col("id") % 7 + 1).cast("int")),
        )
        .withColumn("active_in_crawler", F.when((F.col("page_type_code") == "FRONTIER") & (F.col("id") % 2 == 0), F.lit(True)))
        .withColumn("added_at_time", F.when(F.col("id") % 11 != 0, _at(F.col("id"))))
    )
    known = sites(spark, sf_dir).select("domain", F.col("id").alias("_site"))
    joined = spread_join(typed, known, ["domain"], "left", ["id"])
    site_id = F.when(F.col("page_type_code") != "FRONTIER", F.col("_site"))
    return joined.withColumn("site_id", site_id).drop("_site", "domain")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_links(crawled(spark, sf_dir))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as fetches: status and content type by event type."""
    event = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("page_id"),
        F.col("user_id").alias("site_id"),
        F.col("ts").alias("accessed_time"),
        F.when(event == "error", 404).otherwise(200).alias("status"),
        F.when(event == "view", "text/html; charset=utf-8")
        .when(event == "click", "image/png")
        .when(event == "purchase", "application/pdf")
        .when(event == "signup", "application/pdf; charset=x")
        .alias("content_type"),
        (F.col("event_id") % 13 != 0).alias("robots_ok"),
        F.when(F.col("event_id") % 17 == 0, "timeout").alias("error"),
        F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("html"),
        (F.col("event_id") % 3 == 0).alias("duplicate"),
    )


def fetched_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log with a URL and a body per fetch, and ``_ord``, the order of arrival."""
    number = F.col("event_id").cast("string")
    bodies = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("page_id"),
        F.concat(F.lit("http://a.example.org/i/"), number, F.lit(".bin?v=1")).alias("url"),
        F.when(F.col("event_id") % 19 != 0, F.encode(F.repeat("props", (F.col("event_id") % 5).cast("int")), "UTF-8")).alias("body"),
        F.col("event_id").alias("_ord"),
    )
    return fetch_log(spark, sf_dir).join(bodies, "page_id")


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl delay per site of the fetch log: 0 to 3 hours, NULL for none."""
    seconds = F.col("site_id") % 4 * 3600
    known = table(spark, sf_dir, "events").select(F.col("user_id").alias("site_id")).distinct()
    return known.select("site_id", F.when(seconds > 0, seconds).cast("int").alias("crawl_delay"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages without markup."""
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), F.col("text").alias("html_content")
    )


def marked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose markup names images, scripts and a sitemap entry made from their own URL."""
    number = F.col("page_id").cast("string")
    return spread(table(spark, sf_dir, "pages")).select(
        F.col("page_id").alias("id"),
        F.col("page_id").alias("from_page"),
        "url",
        F.concat(
            F.lit('<img src="/i/'), number, F.lit('.png?v=1#f"><img alt="x" src="data:image/png;base64,AA">'),
            F.lit("<script>location='"), F.col("url"), F.lit("'; a=\"http://nodot/\"</script>"), F.col("html"),
        ).alias("html_content"),
        F.concat(
            F.lit("<urlset><url><loc>"), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")),
            F.lit("</loc></url><url><loc>/s/"), number, F.lit("</loc></url></urlset>"),
        ).alias("content"),
    )


def misread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages behind markup that only a tokenizer reads: ``>`` in values, odd comments, a value that looks like an attribute."""
    number = F.col("id").cast("string")
    odd_link = F.concat(F.lit('<a title="a > b" href="/odd/'), number, F.lit('">o</a>'))
    fronts = [
        odd_link,
        F.concat(F.lit("<a title=' href=x' href='/odd/"), number, F.lit("'>o</a><img alt='2 > 1' src='/i/"), number, F.lit(".png'>")),
        F.concat(odd_link, F.lit('<script data-x="a>b">u = "http://s'), number, F.lit('.example.org/x"</script>')),
    ]
    front = F.lit("")
    for rest, markup in enumerate(fronts):
        front = F.when(F.col("id") % 4 == rest, markup).otherwise(front)
    return crawled(spark, sf_dir).withColumn("html_content", F.concat(front, F.col("html_content")))
