"""Every operator as a named query over the given tables, with the same query in SQL.

``QUERIES[name](spark, sf_dir)`` runs on whole tables. ``ORACLES[name]`` is SQL
for the same tables; queries whose SQL would not finish on whole tables have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webgraph_spark.functions import markup, responses, shingles, urls
from webgraph_spark.operators import budget, claims, contents, crawl, duplicates, extract, frontier, integrity, links, politeness, robots
from webgraph_spark.operators.skew import planned_bytes, spread_join
from webgraph_spark.plans import reports
from webgraph_spark.plans import sample_views as views
from webgraph_spark.plans.oracle import ctes
from webgraph_spark.schemas import DATA_TYPES, PAGE_TYPES
from webgraph_spark.session import cut_lineage, new_path
from webgraph_spark.sources import bucketed, published, seeds, sinks, sitemaps, tables
from webgraph_spark.streaming import fetches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SCOPE = ".example.org"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = ctes(sql)
        return function

    return register


def _pages(spark, sf):
    return views.table(spark, sf, "pages")


def _urls(spark, sf):
    return _pages(spark, sf).select(F.col("page_id").alias("id"), "url")


# --- sources and sinks ------------------------------------------------------


@query(
    """SELECT s.domain, count(*)::BIGINT AS pages, sum(CASE WHEN d.id IS NULL THEN 0 ELSE 1 END)::BIGINT AS copies
    FROM page_v p JOIN site_v s ON s.domain = p.domain
    LEFT JOIN (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY sha256(html) ORDER BY id) AS rn FROM page_v)
      WHERE rn > 1) d ON d.id = p.id
    GROUP BY s.domain"""
)
def site_page_counts(spark, sf):
    hashed = views.crawled(spark, sf).select(
        "id", "ord", urls.origin(F.col("url")).alias("domain"), shingles.content_hash(F.col("html_content")).alias("hash_content")
    )
    hashed = cut_lineage(hashed, "hashed")
    copies = duplicates.exact_duplicates(hashed).select("id", F.lit(1).alias("copy"))
    joined = hashed.select("id", "domain").join(copies, "id", "left")
    return joined.groupBy("domain").agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("copy"), F.lit(0)).alias("copies")
    )


@query("SELECT DISTINCT trim(url) AS url FROM pages WHERE NOT contains(url, '#') AND length(trim(url)) <= 2000")
def read_seeds(spark, sf):
    return seeds.seed_urls(_pages(spark, sf).select(F.col("url").alias("value")))


@query("SELECT id, domain, robots_content FROM site_v")
def scan_sites(spark, sf):
    return tables.scan_sites(views.sites(spark, sf)).drop("last_crawled_at")


@query("SELECT l_orderkey AS from_page, l_partkey AS to_page FROM lineitem")
def scan_links(spark, sf):
    edges = views.table(spark, sf, "lineitem")
    return tables.scan_links(edges.select(F.col("l_orderkey").alias("from_page"), F.col("l_partkey").alias("to_page")))


@query("SELECT id, url, page_type_code FROM state_v WHERE NOT page_type_code = 'FRONTIER'")
def scan_crawled_pages(spark, sf):
    return tables.scan_crawled_pages(views.page_states(spark, sf)).select("id", "url", "page_type_code")


@query("SELECT id, url, site_id FROM state_v WHERE site_id = 1")
def pages_by_site(spark, sf):
    return tables.pages_by_site(views.page_states(spark, sf), 1).select("id", "url", "site_id")


@query(
    """SELECT s.id, s.domain, s.robots_content FROM site_v s
    WHERE s.domain IN (SELECT DISTINCT replace(domain, 'http://', 'https://') FROM page_v)"""
)
def site_by_domain(spark, sf):
    wanted = _pages(spark, sf).select(F.replace(urls.origin(F.col("url")), F.lit("http://"), F.lit("https://")).alias("domain"))
    return tables.site_by_domain(views.sites(spark, sf), wanted).drop("last_crawled_at")


@query(
    """SELECT line, count(*)::BIGINT AS lines FROM (
      SELECT '{"name":"' || url || '","type":"' || page_type_code || '","size":5,"children":[]}' AS line
      FROM state_v WHERE site_id IS NOT NULL
      UNION ALL SELECT '{"name":"' || domain || '","children":[' FROM site_v
      UNION ALL SELECT ']}' FROM site_v
      UNION ALL SELECT '{"name":"Sites","children":[' UNION ALL SELECT ']}') GROUP BY line"""
)
def write_site_tree(spark, sf):
    path = new_path(spark, "site-tree")
    sinks.write_site_tree(views.sites(spark, sf), views.page_states(spark, sf), path)
    lines = spark.read.text(path).select(F.regexp_replace("value", "^,", "").alias("line"))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("lines"))


@query("SELECT source, target, 1::BIGINT AS weight, '' AS type FROM edge_url_v")
def write_link_edges(spark, sf):
    path = new_path(spark, "edges")
    edges = views.candidates(spark, sf).join(views.crawled(spark, sf).select(F.col("id").alias("from_page"), F.col("url").alias("source")), "from_page")
    report = edges.select("source", F.col("to_url").alias("target"), F.lit(1).alias("weight"), F.lit("").alias("type"))
    sinks.write_link_edges(report.distinct(), path)
    return spark.read.schema("source string, target string, weight bigint, type string").json(path)


@query("SELECT l_orderkey AS from_page, l_partkey AS to_page FROM lineitem GROUP BY 1, 2")
def append_links(spark, sf):
    base = new_path(spark, "tables")
    edges = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("from_page"), F.col("l_partkey").alias("to_page"))
    nothing = spark.createDataFrame([], edges.schema)
    tables.append_new(edges, nothing, base, "link", ["from_page"])
    tables.append_new(edges, tables.read_table(spark, base, "link"), base, "link", ["from_page"])
    return tables.read_table(spark, base, "link")


@query("SELECT id, url, page_type_code FROM state_v")
def append_pages(spark, sf):
    base = new_path(spark, "tables")
    pages = views.page_states(spark, sf)
    tables.append_new(pages, spark.createDataFrame([], "url string"), base, "page", ["id"])
    tables.append_new(pages, tables.read_table(spark, base, "page"), base, "page", ["id"])
    return tables.read_table(spark, base, "page").select("id", "url", "page_type_code")


def _budgeted(where: str, limit: int, columns: str) -> str:
    """The rows of ``body_v`` that the byte budget admits, one step per row."""
    return f"""WITH RECURSIVE body_n AS (SELECT *, row_number() OVER (ORDER BY page_id) AS rn FROM body_v WHERE {where}),
    body_step AS (SELECT 0::BIGINT AS rn, 0::BIGINT AS stored, FALSE AS admitted
      UNION ALL SELECT o.rn, s.stored + CASE WHEN s.stored + o.data_size >= {limit} THEN 0 ELSE o.data_size END,
        s.stored + o.data_size < {limit} FROM body_step s JOIN body_n o ON o.rn = s.rn + 1)
    SELECT {columns} FROM body_step s JOIN body_n o ON o.rn = s.rn WHERE s.admitted"""


DATA_LIMIT = 12_000


@query(
    _budgeted(
        "page_type_code = 'BINARY' AND content_type = 'application/pdf'", DATA_LIMIT, "page_id, 'PDF' AS data_type_code, data_size, data_size AS stored"
    )
)
def append_page_data(spark, sf):
    base = new_path(spark, "tables")
    tables.append(contents.page_data_rows(views.fetched_bodies(spark, sf), limit=DATA_LIMIT), base, "page_data")
    stored = tables.read_table(spark, base, "page_data")
    return stored.select("page_id", "data_type_code", "data_size", F.octet_length("data").cast("long").alias("stored"))


@query("SELECT id, domain FROM site_v")
def append_sites(spark, sf):
    base = new_path(spark, "tables")
    sites = views.sites(spark, sf)
    tables.append_new(sites.where("id % 2 = 0"), spark.createDataFrame([], "domain string"), base, "site", ["id"])
    tables.append_new(sites, cut_lineage(tables.read_table(spark, base, "site"), "sites"), base, "site", ["id"])
    return tables.read_table(spark, base, "site").select("id", "domain")


@query(
    _budgeted(
        "page_type_code = 'IMAGE'", DATA_LIMIT, "page_id, content_type, page_id || '.bin?v=1' AS filename, data_size, data_size AS stored"
    )
)
def append_images(spark, sf):
    base = new_path(spark, "tables")
    tables.append(contents.image_rows(views.fetched_bodies(spark, sf), limit=DATA_LIMIT), base, "image")
    stored = tables.read_table(spark, base, "image")
    return stored.select("page_id", "content_type", "filename", "data_size", F.octet_length("data").cast("long").alias("stored"))


@query(
    """SELECT 'image' AS name, count(*)::BIGINT AS rows, sum(data_size)::BIGINT AS total FROM body_v WHERE page_type_code = 'IMAGE'
    UNION ALL SELECT 'page_data', count(*), sum(data_size)::BIGINT FROM body_v WHERE page_type_code = 'BINARY' AND content_type = 'application/pdf'
    UNION ALL SELECT 'link', count(*), sum(to_page)::BIGINT FROM (SELECT DISTINCT l_orderkey AS from_page, l_partkey AS to_page FROM lineitem)"""
)
def publish_batches(spark, sf):
    """Two batches over three tables; the first is published twice, and a writer dies between staging and publishing."""
    base = new_path(spark, "published")
    fetches = views.fetched_bodies(spark, sf)
    edges = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("from_page"), F.col("l_partkey").alias("to_page"))
    for batch, part in [("even", 0), ("odd", 1), ("even", 0)]:
        mine = fetches.where(F.col("page_id") % 2 == part)
        stored = published.read_published(spark, base, "link", without=batch)
        new = links.new_links(edges.where(F.col("from_page") % 2 == part), stored)
        rows = {"image": contents.image_rows(mine), "page_data": contents.page_data_rows(mine), "link": new}
        published.commit(spark, rows, base, batch)
    published.stage({"link": edges}, base, "never")
    read = {name: published.read_published(spark, base, name) for name in ("image", "page_data", "link")}
    sums = [
        rows.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.sum("to_page" if name == "link" else "data_size").alias("total"))
        for name, rows in read.items()
    ]
    return sums[0].unionByName(sums[1]).unionByName(sums[2])


@query(
    """SELECT id, domain, CASE WHEN id % 3 <> 0 THEN robots_content END AS robots_content,
      CASE WHEN id % 8 = 0 THEN domain || 'sitemap.xml' WHEN id % 8 = 5 AND id % 5 <> 0 THEN domain || 'b.xml' END AS sitemap_content
    FROM site_v"""
)
def site_rows(spark, sf):
    """Sites with their files: some robots files are pages, some second sitemaps are missing."""
    sites = views.sites(spark, sf)
    plain = F.when(F.col("id") % 3 != 0, "text/plain; charset=utf-8").otherwise("text/html")
    files = sites.select("domain", F.lit(200).alias("status"), plain.alias("content_type"), F.col("robots_content").alias("body"))
    listed = robots.sitemap_list(_robots_sites(spark, sf)).join(sites.select(F.col("id").alias("site_id"), "domain"), "site_id")
    missing = (F.col("pos") == 2) & (F.col("site_id") % 5 == 0)
    maps = listed.select("domain", "pos", F.when(missing, 404).otherwise(200).alias("status"), F.col("sitemap_url").alias("body"))
    return contents.site_rows(sites, files, maps)


@query("SELECT id AS page_id, n::INTEGER AS hash_length, n::INTEGER AS stored FROM doc_length_v")
def append_signatures(spark, sf):
    base = new_path(spark, "tables")
    tables.append(_document_sigs(spark, sf).withColumnRenamed("id", "page_id"), base, "content_hash")
    stored = tables.read_table(spark, base, "content_hash")
    return stored.select("page_id", "hash_length", F.size("hash").alias("stored"))


@query(
    """SELECT s.id, s.domain, e.last_crawled_at FROM site_v s
    LEFT JOIN (SELECT user_id, max(ts) AS last_crawled_at FROM events GROUP BY user_id) e ON e.user_id = s.id"""
)
def update_sites(spark, sf):
    return crawl.update_sites(views.sites(spark, sf), views.fetch_log(spark, sf)).select("id", "domain", "last_crawled_at")


# --- projections and predicates ---------------------------------------------


@query("SELECT id, domain AS origin FROM page_v")
def url_origin(spark, sf):
    return _pages(spark, sf).select(F.col("page_id").alias("id"), urls.origin(F.col("url")).alias("origin"))


@query("SELECT id, contains(domain, '.example.org') AS in_scope FROM page_v")
def in_scope(spark, sf):
    return _pages(spark, sf).select(F.col("page_id").alias("id"), urls.in_scope(F.col("url"), SCOPE).alias("in_scope"))


@query("SELECT doc_id AS id FROM documents WHERE length(text) <= 2000")
def url_length_ok(spark, sf):
    return views.table(spark, sf, "documents").where(urls.url_length_ok(F.col("text"))).select(F.col("doc_id").alias("id"))


@query("SELECT id, url, added_at_time FROM state_v WHERE page_type_code = 'FRONTIER' AND active_in_crawler IS NULL")
def frontier_ready(spark, sf):
    return frontier.frontier_ready(views.page_states(spark, sf)).select("id", "url", "added_at_time")


@query(
    """SELECT kind, count(*)::BIGINT AS kept FROM (SELECT id, href, kind FROM odd_href_v)
    WHERE href IS NOT NULL AND href <> '' AND (starts_with(href, 'http') OR (NOT contains(href, 'javascript:')
      AND NOT contains(href, 'mailto:') AND NOT contains(href, 'tel:') AND NOT starts_with(href, '#') AND href <> '/'))
    GROUP BY kind"""
)
def skip_link_schemes(spark, sf):
    return _odd_hrefs(spark, sf).where(urls.is_page_link(F.col("href"))).groupBy("kind").agg(F.count(F.lit(1)).alias("kept"))


def _odd_hrefs(spark, sf):
    """Each page's URL in the forms an href may take."""
    url = F.col("url")
    forms = {
        0: F.lit(None).cast("string"), 1: F.lit(""), 2: F.lit("/"), 3: F.concat(F.lit("#"), url),
        4: F.concat(F.lit("javascript:"), url), 5: F.concat(F.lit("mailto:"), url), 6: F.concat(F.lit("tel:"), url),
        7: F.replace(url, F.lit("http"), F.lit("")), 8: F.replace(url, F.lit("http"), F.lit("www")), 9: url,
        10: F.concat(url, F.lit(" é,%20*~'")),
    }
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), form.alias("href")) for kind, form in forms.items()])
    return _pages(spark, sf).select(F.col("page_id").alias("id"), "url", F.inline(rows))


@query(
    """SELECT id, src FROM (SELECT page_id AS id, CASE page_id % 3 WHEN 0 THEN 'data:image/' || url WHEN 1 THEN '' ELSE url END AS src
    FROM pages) WHERE src <> '' AND NOT starts_with(src, 'data:image')"""
)
def skip_image_sources(spark, sf):
    src = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("data:image/"), F.col("url"))).when(F.col("page_id") % 3 == 1, "").otherwise(F.col("url"))
    return _pages(spark, sf).select(F.col("page_id").alias("id"), src.alias("src")).where(urls.is_image_source(F.col("src")))


@query(
    """SELECT page_id, page_type_code,
      (CASE WHEN page_type_code IN ('DISALLOWED', 'ERROR') THEN 500 ELSE status END)::INTEGER AS http_status_code,
      CASE WHEN page_type_code = 'HTML' THEN html END AS html_content,
      CASE WHEN page_type_code IN ('HTML', 'DUPLICATE') THEN sha256(html) END AS hash_content,
      CASE WHEN page_type_code = 'BINARY' AND content_type = 'application/pdf' THEN 'PDF' END AS data_type_code
    FROM typed_v"""
)
def classify_response(spark, sf):
    return crawl.classify_response(views.fetch_log(spark, sf)).drop("site_id", "accessed_time")


@query("SELECT page_id, CASE WHEN content_type = 'application/pdf' THEN 'PDF' END AS data_type_code FROM fetch_v")
def data_type_code(spark, sf):
    return views.fetch_log(spark, sf).select("page_id", responses.data_type_code(F.col("content_type")).alias("data_type_code"))


@query(
    """SELECT s.id, CASE WHEN t.page_id IS NULL THEN s.page_type_code ELSE t.page_type_code END AS page_type_code,
      CASE WHEN t.page_id IS NULL THEN s.site_id ELSE t.site_id END AS site_id,
      CASE WHEN t.page_id IS NULL THEN s.active_in_crawler END AS active_in_crawler,
      t.accessed_time FROM state_v s LEFT JOIN typed_v t ON t.page_id = s.id AND s.page_type_code = 'FRONTIER'"""
)
def crawl_result(spark, sf):
    results = crawl.classify_response(views.fetch_log(spark, sf))
    pages = views.page_states(spark, sf).withColumn("accessed_time", F.lit(None).cast("timestamp_ntz"))
    return crawl.crawl_result(pages, results).select("id", "page_type_code", "site_id", "active_in_crawler", "accessed_time")


@query("SELECT id, CASE WHEN page_type_code <> 'FRONTIER' THEN active_in_crawler END AS active_in_crawler FROM state_v")
def reset_active(spark, sf):
    return crawl.reset_active(views.page_states(spark, sf)).select("id", "active_in_crawler")


@query(
    """SELECT s.id, CASE WHEN e.user_id IS NULL THEN active_in_crawler END AS active_in_crawler
    FROM state_v s LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON e.user_id = s.id"""
)
def return_to_frontier(spark, sf):
    ids = views.table(spark, sf, "events").select(F.col("user_id").alias("id"))
    return crawl.return_to_frontier(views.page_states(spark, sf), ids).select("id", "active_in_crawler")


@query(
    """SELECT id, CASE page_type_code WHEN 'DISALLOWED' THEN 'grey' WHEN 'ERROR' THEN 'red' WHEN 'DUPLICATE' THEN 'yellow'
    ELSE 'default' END AS colour FROM state_v"""
)
def type_colour(spark, sf):
    return views.page_states(spark, sf).select("id", responses.type_colour(F.col("page_type_code")).alias("colour"))


# --- joins ------------------------------------------------------------------

REPORT_SITE = "https://m.ththth.example.net/"


@query(
    f"""SELECT e.from_page, e.to_page, p1.url AS source, p2.url AS target FROM graph_v e
    JOIN state_v p1 ON p1.id = e.from_page JOIN state_v p2 ON p2.id = e.to_page JOIN site_v s ON s.id = p1.site_id
    WHERE s.domain = '{REPORT_SITE}' ORDER BY 1, 2 LIMIT 300"""
)
def links_of_domain(spark, sf):
    return links.links_of_domain(_graph(spark, sf), views.page_states(spark, sf), views.sites(spark, sf), REPORT_SITE, 300)


@query(
    f"""SELECT e.from_page, e.to_page, p1.url AS source, p2.url AS target FROM graph_v e
    JOIN state_v p1 ON p1.id = e.from_page JOIN state_v p2 ON p2.id = e.to_page JOIN site_v s ON s.id = p1.site_id
    WHERE s.domain = '{REPORT_SITE}'"""
)
def all_links_of_domain(spark, sf):
    return links.links_of_domain(_graph(spark, sf), views.page_states(spark, sf), views.sites(spark, sf), REPORT_SITE)


def _graph(spark, sf):
    """Edges between known pages: order and part of every line item, folded onto the page ids."""
    count = _pages(spark, sf).agg(F.count(F.lit(1))).scalar()
    edges = views.table(spark, sf, "lineitem")
    return edges.select((F.col("l_orderkey") % count).alias("from_page"), (F.col("l_partkey") % count).alias("to_page")).distinct()


@query("SELECT p.id, p.domain, s.id AS site_id FROM page_v p LEFT JOIN site_v s ON s.domain = p.domain AND s.id % 2 = 0")
def pages_with_site(spark, sf):
    known = views.sites(spark, sf).where("id % 2 = 0")
    return frontier.pages_with_site(_urls(spark, sf), known).select("id", "domain", "site_id")


@query(
    """SELECT (SELECT max(id) FROM site_v WHERE id % 2 = 0) + row_number() OVER (ORDER BY id) AS id, domain
    FROM site_v WHERE id % 2 = 1"""
)
def missing_sites(spark, sf):
    known = views.sites(spark, sf).where("id % 2 = 0")
    return frontier.missing_sites(_urls(spark, sf), known)


@query("SELECT id, url FROM created_v")
def new_pages(spark, sf):
    created, _ = frontier.resolve_candidates(views.candidates(spark, sf), _urls(spark, sf))
    return created


@query(
    """SELECT DISTINCT c.from_page, coalesce(p.page_id, n.id) AS to_page FROM cand_v c
    LEFT JOIN pages p ON p.url = c.to_url LEFT JOIN created_v n ON n.url = c.to_url"""
)
def resolve_candidates(spark, sf):
    _, edges = frontier.resolve_candidates(views.candidates(spark, sf), _urls(spark, sf))
    return edges


@query(
    """SELECT DISTINCT l_orderkey AS from_page, l_partkey AS to_page FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem o WHERE o.l_returnflag = 'N' AND o.l_orderkey = l.l_orderkey AND o.l_partkey = l.l_partkey)"""
)
def new_links(spark, sf):
    rows = views.table(spark, sf, "lineitem")
    edges = rows.select("l_returnflag", F.col("l_orderkey").alias("from_page"), F.col("l_partkey").alias("to_page"))
    return links.new_links(edges, edges.where("l_returnflag = 'N'"))


@query("SELECT id, url FROM created_v")
def new_pages_stored(spark, sf):
    """Against a page table in buckets by url; only the candidates are moved."""
    name = bucketed.write_bucketed(_urls(spark, sf), ["url"], 16)
    return frontier.new_pages(views.candidates(spark, sf), bucketed.read_bucketed(spark, name), 16)


@query(
    """SELECT DISTINCT l_orderkey AS from_page, l_partkey AS to_page FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem o WHERE o.l_returnflag = 'N' AND o.l_orderkey = l.l_orderkey AND o.l_partkey = l.l_partkey)"""
)
def new_links_stored(spark, sf):
    """Against a link table in buckets by both pages; only the edges are moved."""
    rows = views.table(spark, sf, "lineitem")
    edges = rows.select("l_returnflag", F.col("l_orderkey").alias("from_page"), F.col("l_partkey").alias("to_page"))
    stored = edges.where("l_returnflag = 'N'").select("from_page", "to_page")
    name = bucketed.write_bucketed(stored, ["from_page", "to_page"], 16)
    return links.new_links(edges, bucketed.read_bucketed(spark, name), 16)


@query(
    """SELECT a.id AS a_id, b.id AS b_id, count(*)::BIGINT AS common
    FROM bench_shingle_v a JOIN doc_shingle_v b ON a.shingle = b.shingle GROUP BY 1, 2"""
)
def shingle_overlap(spark, sf):
    return duplicates.shingle_overlap(_benchmark_sigs(spark, sf), _document_sigs(spark, sf))


def _document_sigs(spark, sf):
    return duplicates.text_signatures(views.texts(spark, sf).withColumnRenamed("html_content", "text"))


def _benchmark_sigs(spark, sf):
    items = views.table(spark, sf, "benchmark")
    return duplicates.text_signatures(items.select(F.col("item_id").alias("id"), F.col("item_id").alias("ord"), "text"))


@query(
    """SELECT a.id AS a_id, b.id AS b_id, count(*)::BIGINT AS common
    FROM bench_shingle_v a JOIN doc_shingle_v b ON a.shingle = b.shingle GROUP BY 1, 2"""
)
def lateral_overlap_count(spark, sf):
    a = cut_lineage(_benchmark_sigs(spark, sf), "signatures")
    b = cut_lineage(_document_sigs(spark, sf), "signatures")
    return duplicates.lateral_overlap_count(a, b, duplicates.shingle_overlap(a, b))


@query(
    """SELECT a_id, b_id, common, b_length FROM (
      SELECT a.id AS a_id, b.id AS b_id, count(*)::BIGINT AS common, any_value(n.n)::INTEGER AS b_length,
        row_number() OVER (PARTITION BY a.id ORDER BY count(*) DESC, any_value(n.n), b.id) AS rn
      FROM bench_shingle_v a JOIN doc_shingle_v b ON a.shingle = b.shingle
      JOIN (SELECT id, count(*) AS n FROM doc_shingle_v GROUP BY id) n ON n.id = b.id GROUP BY a.id, b.id) WHERE rn = 1"""
)
def best_overlap(spark, sf):
    sigs = _document_sigs(spark, sf)
    pairs = duplicates.shingle_overlap(_benchmark_sigs(spark, sf), sigs)
    lengths = sigs.select(F.col("id").alias("b_id"), F.col("hash_length").alias("b_length"))
    return duplicates.best_overlap(pairs.join(lengths, "b_id"))


@query(
    """SELECT p.id, coalesce((SELECT r.allow FROM rule_v r WHERE r.site_id = s.id AND r.is_default
        AND r.group_no = (SELECT min(group_no) FROM rule_v g WHERE g.site_id = s.id AND g.is_default)
        AND r.path IS NOT NULL AND starts_with(p.robots_path, r.path) ORDER BY r.rule_no LIMIT 1), TRUE) AS allowed
    FROM page_v p JOIN site_v s ON s.domain = p.domain"""
)
def robots_decision(spark, sf):
    sites = views.sites(spark, sf)
    located = frontier.pages_with_site(_pages(spark, sf).select(F.col("page_id").alias("id"), "url"), sites)
    targets = cut_lineage(located, "located")
    rules = robots.robots_rules(sites.select(F.col("id").alias("site_id"), "robots_content"))
    return robots.robots_decision(targets.select("id", "site_id", "url"), rules).select("id", "allowed")


# --- aggregates -------------------------------------------------------------


@query("SELECT count(page_id)::BIGINT AS pages FROM pages")
def page_count(spark, sf):
    return frontier.page_count(views.crawled(spark, sf))


@query("SELECT coalesce(sum(n_chars), 0)::BIGINT AS bytes FROM documents")
def stored_bytes(spark, sf):
    return budget.stored_bytes(_items(spark, sf))


def _items(spark, sf):
    return views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("data_size"))


@query("SELECT user_id AS site_id, max(ts) AS last_crawled_at FROM events GROUP BY user_id")
def site_last_crawled(spark, sf):
    return crawl.site_last_crawled(views.fetch_log(spark, sf))


@query(
    """SELECT s.id AS site_id, s.domain AS name, count(p.id)::BIGINT AS children, coalesce(sum(5) FILTER (p.id IS NOT NULL), 0)::BIGINT AS size
    FROM site_v s LEFT JOIN state_v p ON p.site_id = s.id GROUP BY 1, 2"""
)
def site_tree(spark, sf):
    tree = reports.site_tree(views.sites(spark, sf), views.page_states(spark, sf))
    sizes = F.aggregate("children", F.lit(0).cast("bigint"), lambda total, c: total + c["size"])
    return tree.groupBy("site_id", "name").agg(
        F.sum(F.size("children")).alias("children"), F.sum(sizes).alias("size")
    )


@query(
    """SELECT s.domain, p.url, (grouping(s.domain) * 2 + grouping(p.url))::INTEGER AS level, (5 * count(*))::BIGINT AS size
    FROM state_v p JOIN site_v s ON s.id = p.site_id GROUP BY ROLLUP (s.domain, p.url)"""
)
def tree_size_rollup(spark, sf):
    return reports.tree_size_rollup(views.sites(spark, sf), views.page_states(spark, sf))


@query("SELECT id, greatest(n_words - 9, 0)::INTEGER AS windows, n::INTEGER AS hash_length FROM doc_length_v")
def signature_length(spark, sf):
    texts = views.texts(spark, sf)
    return texts.select(
        "id",
        F.size(shingles.word_shingles(F.col("html_content"))).alias("windows"),
        shingles.signature_length(shingles.shingle_set(F.col("html_content"))).alias("hash_length"),
    )


# --- windows, order, limits -------------------------------------------------


@query(
    """SELECT page_id, site_id, crawl_delay, gap, coalesce(crawl_delay - gap > 0, FALSE) AS violation,
      (CASE WHEN crawl_delay - gap > 0 THEN crawl_delay - gap ELSE 0 END)::DOUBLE AS wait,
      (CASE WHEN crawl_delay - gap > 0 THEN crawl_delay ELSE 0 END)::INTEGER AS slept
    FROM (SELECT event_id AS page_id, user_id AS site_id,
        (CASE WHEN user_id % 4 > 0 THEN user_id % 4 * 3600 END)::INTEGER AS crawl_delay,
        (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6 AS gap FROM events
      WHERE event_id % 13 <> 0)"""
)
def politeness_audit(spark, sf):
    return politeness.politeness_audit(views.fetch_log(spark, sf), views.delays(spark, sf)).drop("accessed_time", "last_crawled_at")


@query(
    """SELECT page_id, site_id, (max(t - i * delay) OVER (PARTITION BY site_id ORDER BY i) + i * delay - t)::BIGINT AS wait
    FROM (SELECT event_id AS page_id, user_id AS site_id, epoch_us(ts) AS t, user_id % 4 * 3600000000 AS delay,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)"""
)
def politeness_schedule(spark, sf):
    return politeness.politeness_schedule(views.fetch_log(spark, sf), views.delays(spark, sf))


BUDGET_LIMIT = 400_000


@query(
    f"""WITH RECURSIVE ordered AS (SELECT doc_id AS id, n_chars AS size, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
    step AS (SELECT 0::BIGINT AS rn, NULL::BIGINT AS id, 0::BIGINT AS size, 0::BIGINT AS stored, FALSE AS admitted
      UNION ALL SELECT o.rn, o.id, o.size, s.stored + CASE WHEN s.stored + o.size >= {BUDGET_LIMIT} THEN 0 ELSE o.size END,
        s.stored + o.size < {BUDGET_LIMIT} FROM step s JOIN ordered o ON o.rn = s.rn + 1)
    SELECT id, size AS data_size, admitted FROM step WHERE rn > 0"""
)
def byte_budget(spark, sf):
    return budget.byte_budget(_items(spark, sf), ["id"], BUDGET_LIMIT)


@query(
    """SELECT id, url, TRUE AS active_in_crawler FROM state_v WHERE page_type_code = 'FRONTIER' AND active_in_crawler IS NULL
    ORDER BY added_at_time ASC NULLS LAST, id LIMIT 5"""
)
def next_from_frontier(spark, sf):
    return frontier.next_from_frontier(views.page_states(spark, sf), 5).select("id", "url", "active_in_crawler")


@query(
    """WITH RECURSIVE c AS (
      SELECT event_id AS claim_id, user_id AS page_id, (event_id % 2)::BIGINT AS taker, ts AS at,
        ts + to_hours((6 + event_id % 3)::INTEGER) AS until, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    nxt AS (SELECT a.page_id, a.rn, min(b.rn) AS following FROM c a JOIN c b ON b.page_id = a.page_id AND b.rn > a.rn AND b.at >= a.until GROUP BY 1, 2),
    w AS (SELECT page_id, 1::BIGINT AS rn FROM c WHERE rn = 1
      UNION ALL SELECT w.page_id, nxt.following FROM w JOIN nxt ON nxt.page_id = w.page_id AND nxt.rn = w.rn)
    SELECT c.claim_id, c.page_id, c.taker, w.rn IS NOT NULL AS won FROM c LEFT JOIN w ON w.page_id = c.page_id AND w.rn = c.rn"""
)
def frontier_claims(spark, sf):
    """Two takers; leases of six to eight hours that expire."""
    claim = F.col("event_id")
    log = views.table(spark, sf, "events").select(
        claim.alias("claim_id"), F.col("user_id").alias("page_id"), (claim % 2).alias("taker"), F.col("ts").alias("at"), ((claim % 3 + 6) * 3600).alias("lease")
    )
    return claims.fold_claims(log)


@query(
    """SELECT id, url, domain AS site, place::INTEGER AS place FROM (SELECT id, url, domain,
      row_number() OVER (PARTITION BY domain ORDER BY added_at_time ASC NULLS LAST, id) AS place
      FROM state_v WHERE page_type_code = 'FRONTIER' AND active_in_crawler IS NULL) WHERE place <= 2"""
)
def next_per_site(spark, sf):
    return frontier.next_per_site(views.page_states(spark, sf), 2).select("id", "url", "site", "place")


@query("SELECT DISTINCT l_orderkey AS from_page, l_partkey AS to_page FROM lineitem ORDER BY 1, 2 LIMIT 1500")
def limit_links(spark, sf):
    edges = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("from_page"), F.col("l_partkey").alias("to_page"))
    return links.limit_links(edges.distinct(), 1500)


@query(
    """SELECT s.domain, (5 * count(*))::BIGINT AS size FROM state_v p JOIN site_v s ON s.id = p.site_id
    GROUP BY s.domain ORDER BY size DESC, s.domain"""
)
def tree_order(spark, sf):
    nodes = reports.tree_size_rollup(views.sites(spark, sf), views.page_states(spark, sf)).where("level = 1")
    return reports.tree_order(nodes).select("domain", "size")


@query("SELECT from_page, to_url, 'fits' AS cap FROM cand_v")
def row_cap(spark, sf):
    """The cap that the page table just meets, and the one below it, which refuses the batch."""
    pages = views.crawled(spark, sf)
    rows = frontier.page_count(pages).first()[0]
    batch = views.candidates(spark, sf).select("from_page", "to_url")
    below = frontier.row_cap(batch, pages, rows - 1).withColumn("cap", F.lit("below"))
    return frontier.row_cap(batch, pages, rows).withColumn("cap", F.lit("fits")).unionByName(below)


@query(
    """SELECT l.l_orderkey, l.l_linenumber, s.s_name FROM lineitem l
    LEFT JOIN supplier s ON s.s_suppkey = CASE WHEN l.l_linenumber % 3 = 0 THEN 1 ELSE l.l_suppkey END"""
)
def spread_lookup(spark, sf):
    """A lookup in which a third of the rows have one key, always in the spread form."""
    key = F.when(F.col("l_linenumber") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_suppkey"))
    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.alias("s_suppkey"))
    names = views.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    joined = spread_join(rows, names, ["s_suppkey"], "left", ["l_orderkey", "l_linenumber"], hot_rows=2000, lookup_bytes=0)
    return joined.select("l_orderkey", "l_linenumber", "s_name")


# --- sets -------------------------------------------------------------------


@query(
    """SELECT kind, count(*)::BIGINT AS candidates FROM (SELECT 'a' AS kind FROM cand_v UNION ALL SELECT 'img' FROM pages
    UNION ALL SELECT 'script' FROM pages UNION ALL SELECT unnest(['sitemap', 'sitemap']) FROM pages) GROUP BY kind"""
)
def all_candidates(spark, sf):
    pages = views.marked_up(spark, sf)
    found = extract.all_candidates(
        extract.extract_links(pages), extract.extract_images(pages), extract.extract_script_links(pages), extract.extract_sitemap_urls(pages)
    )
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("candidates"))


@query("SELECT l_orderkey AS node FROM lineitem UNION SELECT l_partkey FROM lineitem")
def graph_nodes(spark, sf):
    return links.graph_nodes(views.table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")


@query(
    """SELECT l_partkey AS key, min(l_orderkey) AS first FROM lineitem
    WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY l_partkey"""
)
def admit_unique(spark, sf):
    new = views.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_orderkey").alias("first"))
    existing = views.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))
    return frontier.admit_unique(new, existing, ["key"], ["first"])


@query(
    """SELECT a.id AS a_id, b.id AS b_id, round(count(*) / (any_value(na.n) + any_value(nb.n) - count(*)), 9) AS similarity
    FROM bench_shingle_v a JOIN doc_shingle_v b ON a.shingle = b.shingle
    JOIN (SELECT id, count(*) AS n FROM bench_shingle_v GROUP BY id) na ON na.id = a.id
    JOIN (SELECT id, count(*) AS n FROM doc_shingle_v GROUP BY id) nb ON nb.id = b.id GROUP BY a.id, b.id"""
)
def jaccard(spark, sf):
    a, b = _benchmark_sigs(spark, sf), _document_sigs(spark, sf)
    pairs = duplicates.shingle_overlap(a, b)
    sized = pairs.join(a.select(F.col("id").alias("a_id"), F.col("hash_length").alias("a_n")), "a_id").join(
        b.select(F.col("id").alias("b_id"), F.col("hash_length").alias("b_n")), "b_id"
    )
    similarity = shingles.jaccard_from_counts(F.col("common"), F.col("a_n"), F.col("b_n"))
    return sized.select("a_id", "b_id", F.round(similarity, 9).alias("similarity"))


# --- scalar functions and extraction ----------------------------------------


@query("SELECT id, kind, canonical FROM canonical_v")
def canonical_link(spark, sf):
    link = urls.canonical_link(F.col("href"), urls.origin(F.col("url")))
    return _odd_hrefs(spark, sf).select("id", "kind", link.alias("canonical"))


@query(
    """SELECT doc_id AS id, sha256(replace(replace(replace(replace(replace(replace(url_encode(text), '%3A', ':'), '%2F', '/'),
      '%26', '&'), '%3F', '?'), '%2B', '+'), '%3D', '=')) AS encoded FROM documents"""
)
def percent_encode(spark, sf):
    return views.texts(spark, sf).select("id", F.sha2(urls.percent_encode(F.col("html_content")), 256).alias("encoded"))


@query("SELECT doc_id AS id, sha256(text) AS decoded FROM documents")
def percent_decode(spark, sf):
    encoded = urls.percent_encode(F.col("html_content"), {})
    return views.texts(spark, sf).select("id", F.sha2(urls.percent_decode(encoded), 256).alias("decoded"))


@query("SELECT id, CASE WHEN NOT starts_with(url, 'data:image') THEN domain || 'i/' || id || '.png?v=1#f' END AS image FROM page_v")
def canonical_image(spark, sf):
    src = F.concat(F.lit("/i/"), F.col("page_id").cast("string"), F.lit(".png?v=1#f"))
    return _pages(spark, sf).select(
        F.col("page_id").alias("id"), urls.canonical_image(src, urls.origin(F.col("url"))).alias("image")
    )


@query("SELECT page_id AS id, string_split(url, '/')[-1] AS filename FROM pages")
def image_filename(spark, sf):
    return _pages(spark, sf).select(F.col("page_id").alias("id"), urls.image_filename(F.col("url")).alias("filename"))


@query("SELECT id, robots_path FROM page_v")
def robots_path(spark, sf):
    return _pages(spark, sf).select(F.col("page_id").alias("id"), urls.robots_path(F.col("url")).alias("robots_path"))


@query("SELECT from_page, to_url, pos::INTEGER AS pos FROM cand_v")
def extract_links(spark, sf):
    return views.candidates(spark, sf).select("from_page", "to_url", "pos")


@query("SELECT id AS from_page, domain || 'i/' || id || '.png?v=1#f' AS to_url FROM page_v")
def extract_images(spark, sf):
    return extract.extract_images(views.marked_up(spark, sf)).select("from_page", "to_url")


@query("SELECT page_id AS from_page, string_split(url, '#')[1] AS to_url FROM pages")
def extract_script_links(spark, sf):
    return extract.extract_script_links(views.marked_up(spark, sf)).select("from_page", "to_url")


@query(
    """SELECT page_id AS from_page, string_split(url, '#')[1] AS to_url FROM pages
    UNION ALL SELECT id, domain || 's/' || id FROM page_v"""
)
def extract_sitemap_urls(spark, sf):
    return extract.extract_sitemap_urls(views.marked_up(spark, sf)).select("from_page", "to_url")


@query(
    """SELECT s.id AS from_page, string_split(p.url, '#')[1] AS to_url FROM page_v p JOIN site_v s USING (domain)
    UNION ALL SELECT s.id, domain || 's/' || p.id FROM page_v p JOIN site_v s USING (domain)"""
)
def sitemap_files(spark, sf):
    """The entries of all pages of a site as files of the site, read in parts."""
    path = new_path(spark, "sitemap-files")
    sites = views.sites(spark, sf).select(F.col("id").alias("site_id"), F.col("id").alias("from_page"), F.col("domain").alias("url"))
    located = views.marked_up(spark, sf).select(urls.origin(F.col("url")).alias("domain"), "content")
    known = sites.select(F.col("url").alias("domain"), "site_id")
    located.join(known, "domain").select("site_id", "content").write.partitionBy("site_id").text(path)
    return extract.sitemap_entries(sitemaps.read_sitemap_files(spark, path), sites).select("from_page", "to_url")


@query(
    """SELECT from_page, to_url, 'a' AS kind FROM cand_v
    UNION ALL SELECT id, domain || 'odd/' || id, 'a' FROM page_v WHERE id % 4 < 3
    UNION ALL SELECT id, domain || 'i/' || id || '.png', 'img' FROM page_v WHERE id % 4 = 1
    UNION ALL SELECT id, 'http://s' || id || '.example.org/x', 'script' FROM page_v WHERE id % 4 = 2"""
)
def page_candidates(spark, sf):
    """Pages of which three in four begin with markup that the patterns misread."""
    return extract.page_candidates(views.misread_pages(spark, sf)).select("from_page", "to_url", "kind")


@query("SELECT id, sha256(text) AS text_hash, length(text)::INTEGER AS n_chars FROM page_text_v")
def strip_markup(spark, sf):
    read = views.crawled(spark, sf).select("id", markup.strip_markup(F.col("html_content")).alias("text"))
    return read.select("id", F.sha2("text", 256).alias("text_hash"), F.char_length("text").alias("n_chars"))


@query("SELECT id, sha256(text) AS text_hash, 1::INTEGER AS scripts FROM page_text_v")
def tokenize_pages(spark, sf):
    read = extract.tokenize_pages(views.crawled(spark, sf))
    return read.select("id", F.sha2("text", 256).alias("text_hash"), F.size("scripts").alias("scripts"))


@query("SELECT page_id AS id, sha256(html) AS hash_content FROM pages")
def content_hash(spark, sf):
    return _pages(spark, sf).select(F.col("page_id").alias("id"), shingles.content_hash(F.col("html")).alias("hash_content"))


@query("SELECT shingle, count(*)::BIGINT AS pages FROM doc_shingle_v GROUP BY shingle")
def word_shingles(spark, sf):
    texts = views.texts(spark, sf)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), planned_bytes(texts) // shingles.DEALT_BYTES + 1)
    return shingles.shingle_counts(texts, "html_content", parts)


@query(
    """SELECT site_id, group_no::INTEGER AS group_no, rule_no::INTEGER AS rule_no, path, allow, is_default FROM rule_v WHERE path IS NOT NULL"""
)
def robots_rules(spark, sf):
    rules = robots.robots_rules(_robots_sites(spark, sf))
    return rules.select("site_id", "group_no", "is_default", F.inline("rules"))


def _robots_sites(spark, sf):
    return views.sites(spark, sf).select(F.col("id").alias("site_id"), "robots_content")


@query(
    """SELECT site_id, delay::INTEGER AS crawl_delay FROM (SELECT site_id, group_no, max(delay) AS delay,
      row_number() OVER (PARTITION BY site_id ORDER BY group_no) AS rn FROM rule_v WHERE is_default GROUP BY 1, 2) WHERE rn = 1"""
)
def robots_crawl_delay(spark, sf):
    return robots.robots_crawl_delay(robots.robots_rules(_robots_sites(spark, sf)))


@query(
    """SELECT site_id, requests, seconds FROM (SELECT site_id, group_no,
      max(CASE WHEN key = 'request-rate' THEN 1 END)::INTEGER AS requests, max(CASE WHEN key = 'request-rate' THEN 5 END)::INTEGER AS seconds,
      row_number() OVER (PARTITION BY site_id ORDER BY group_no) AS rn FROM rule_v WHERE is_default GROUP BY 1, 2) WHERE rn = 1"""
)
def robots_request_rate(spark, sf):
    rates = robots.robots_request_rate(robots.robots_rules(_robots_sites(spark, sf)))
    return rates.select("site_id", "request_rate.requests", "request_rate.seconds")


@query("SELECT page_id FROM fetch_v WHERE status = 200 AND contains(replace(content_type, 'html', 'plain'), 'text/plain')")
def robots_file_usable(spark, sf):
    plain = F.replace(F.col("content_type"), F.lit("html"), F.lit("plain"))
    return robots.robots_file_usable(views.fetch_log(spark, sf).withColumn("content_type", plain)).select("page_id")


@query("SELECT page_id FROM fetch_v WHERE status = 200")
def sitemap_file_usable(spark, sf):
    return robots.sitemap_file_usable(views.fetch_log(spark, sf)).select("page_id")


@query(
    """SELECT id AS site_id, 1 AS pos, domain || 'sitemap.xml' AS sitemap_url FROM site_v WHERE id % 8 = 0
    UNION ALL SELECT id, 1, domain || 'a.xml' FROM site_v WHERE id % 8 = 5
    UNION ALL SELECT id, 2, domain || 'b.xml' FROM site_v WHERE id % 8 = 5"""
)
def sitemap_list(spark, sf):
    return robots.sitemap_list(_robots_sites(spark, sf))


# --- streaming --------------------------------------------------------------


def _arriving(rows: DataFrame, order: str, parts: int):
    """A folder, and steps that each add the next part of ``rows`` to it as one more file or set of files."""
    spark = rows.sparkSession
    bounds = rows.approxQuantile(order, [k / parts for k in range(1, parts)], 0.01)
    path = new_path(spark, "arriving")

    def step(low, high):
        inside = F.lit(True) if low is None else F.col(order) > low
        part = rows.where(inside if high is None else inside & (F.col(order) <= high))
        return lambda: part.write.mode("append").parquet(path)

    return path, [step(low, high) for low, high in zip([None, *bounds], [*bounds, None])]


@query("SELECT sha256(props) AS hash_content, any_value(props) AS html_content, 1::BIGINT AS times FROM events GROUP BY 1")
def stream_exact_dedup(spark, sf):
    """Several batches, and a restart from the checkpoint between them."""
    fetches.durable_state(spark)
    rows = views.table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("at"), F.col("props").alias("html_content")
    )
    folder, steps = _arriving(rows.withColumn("hash_content", shingles.content_hash(F.col("html_content"))), "event_id", 4)
    path, state = new_path(spark, "unique"), new_path(spark, "unique-state")
    for add in steps:
        add()
        schema = "event_id bigint, at timestamp, html_content string, hash_content string"
        # All of the log lies within the delay, so nothing is forgotten.
        stream = fetches.stream_exact_dedup(fetches.fetch_stream(spark, folder, schema), "at", "36500 days")
        fetches.run_rows(stream.select("hash_content", "html_content"), path, state)
    pages = spark.read.schema("hash_content string, html_content string").parquet(path)
    return pages.groupBy("hash_content", "html_content").agg(F.count(F.lit(1)).alias("times"))


@query("SELECT sha256(props) AS hash_content, min(event_id) AS first_id, count(*)::BIGINT AS copies FROM events GROUP BY 1")
def stream_first_seen(spark, sf):
    schema = views.table(spark, sf, "events").schema
    stream = fetches.fetch_stream(spark, sf, schema, pattern="events.parquet")
    pages = stream.select(
        F.col("event_id").alias("id"), F.col("event_id").alias("ord"), shingles.content_hash(F.col("props")).alias("hash_content")
    )
    updates = fetches.run_updates(fetches.stream_first_seen(pages), "first-seen")
    latest = F.max_by(F.struct("first_id", "copies"), "batch").alias("_latest")
    return updates.groupBy("hash_content").agg(latest).select("hash_content", "_latest.*")


@query("SELECT user_id AS site_id, max(ts) AS last_crawled_at FROM events GROUP BY user_id")
def stream_site_last_crawled(spark, sf):
    schema = views.table(spark, sf, "events").schema
    stream = fetches.fetch_stream(spark, sf, schema, pattern="events.parquet")
    log = stream.select(F.col("user_id").alias("site_id"), F.col("ts").alias("accessed_time"))
    updates = fetches.run_updates(fetches.stream_site_last_crawled(log), "last-crawled")
    return updates.groupBy("site_id").agg(F.max("last_crawled_at").alias("last_crawled_at"))


@query("SELECT id, status FROM marks_v")
def stream_near_dup(spark, sf):
    """Four batches, each taken up by a stream that starts again from its checkpoint."""
    texts = views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "text")
    folder, steps = _arriving(texts, "ord", 4)
    store, state = new_path(spark, "near-dup"), new_path(spark, "near-dup-state")
    for add in steps:
        add()
        fetches.stream_near_dup(fetches.fetch_stream(spark, folder, texts.schema), store, state).awaitTermination()
    return spark.read.schema("id bigint, status string").parquet(f"{store}/marks/*")


# --- duplicates -------------------------------------------------------------


@query("SELECT id, n::INTEGER AS hash_length FROM page_length_v")
def page_signatures(spark, sf):
    return duplicates.page_signatures(views.crawled(spark, sf)).select("id", "hash_length")


@query(
    """SELECT id, matched_id FROM (SELECT doc_id AS id, row_number() OVER w AS rn, first_value(doc_id) OVER w AS matched_id
    FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY doc_id)) WHERE rn > 1"""
)
def exact_duplicates(spark, sf):
    hashed = views.texts(spark, sf).select("id", "ord", shingles.content_hash(F.col("html_content")).alias("hash_content"))
    return duplicates.exact_duplicates(cut_lineage(hashed, "hashed"))


@query("SELECT id, status, matched_id, similarity FROM marks_v")
def mark_duplicates(spark, sf):
    return duplicates.mark_duplicates(views.texts(spark, sf), text=F.col("html_content"))


@query("SELECT id, status, matched_id, similarity FROM marks_v@0.5")
def mark_duplicates_loose(spark, sf):
    return duplicates.mark_duplicates(views.texts(spark, sf), 0.5, text=F.col("html_content"))


@query("SELECT id, status, matched_id, similarity FROM marks_v@0.5")
def mark_duplicates_stored(spark, sf):
    """The documents in two batches, the second compared with what the first has left."""
    texts = views.texts(spark, sf)
    middle = texts.agg(F.max("id")).first()[0] // 2
    content = F.col("html_content")
    first, second = texts.where(F.col("id") <= middle), texts.where(F.col("id") > middle)
    marks = cut_lineage(duplicates.mark_duplicates(first, 0.5, text=content), "first-marks")
    hashes = first.select("id", "ord", shingles.content_hash(content).alias("hash_content"))
    kept = first.join(marks.where("status = 'kept'").select("id"), "id")
    signatures = duplicates.text_signatures(kept.select("id", "ord", content.alias("text")))
    later = duplicates.mark_duplicates(second, 0.5, text=content, stored_hashes=hashes, stored_signatures=signatures)
    return marks.unionByName(later)


@query("SELECT id, status, matched_id, similarity FROM page_marks_v")
def mark_duplicate_pages(spark, sf):
    return duplicates.mark_duplicates(views.crawled(spark, sf))


@query("SELECT id, matched_id, similarity FROM page_marks_v@0.5 WHERE status = 'near'")
def near_duplicates(spark, sf):
    return duplicates.near_duplicates(duplicates.page_signatures(views.crawled(spark, sf)), 0.5)


# --- reports and integrity --------------------------------------------------


@query(
    """SELECT s.id AS site_id, s.domain AS name, p.url, p.page_type_code AS type, (CASE WHEN p.id IS NOT NULL THEN 5 END)::INTEGER AS size
    FROM site_v s LEFT JOIN state_v p ON p.site_id = s.id"""
)
def site_page_tree(spark, sf):
    tree = reports.site_page_tree(views.sites(spark, sf), views.page_states(spark, sf))
    node = "name string, children array<struct<name string, type string, size int, children array<string>>>"
    read = tree.select("site_id", F.from_json("json", node).alias("n")).select("site_id", "n.name", F.explode_outer("n.children").alias("c"))
    return read.select("site_id", "name", F.col("c.name").alias("url"), "c.type", "c.size")


@query(
    f"""SELECT p1.url AS source, p2.url AS target, 1 AS weight, '' AS type FROM graph_v e
    JOIN state_v p1 ON p1.id = e.from_page JOIN state_v p2 ON p2.id = e.to_page JOIN site_v s ON s.id = p1.site_id
    WHERE s.domain = '{REPORT_SITE}' ORDER BY e.from_page, e.to_page LIMIT 400"""
)
def domain_link_report(spark, sf):
    return reports.domain_link_report(
        _graph(spark, sf), views.page_states(spark, sf), views.sites(spark, sf), REPORT_SITE, 400
    )


@query(
    """SELECT s.domain, p.page_type_code, CASE p.page_type_code WHEN 'DISALLOWED' THEN 'grey' WHEN 'ERROR' THEN 'red'
      WHEN 'DUPLICATE' THEN 'yellow' ELSE 'default' END AS colour, count(*)::BIGINT AS pages
    FROM state_v p JOIN site_v s ON s.id = p.site_id GROUP BY 1, 2, 3"""
)
def type_counts_by_site(spark, sf):
    return reports.type_counts_by_site(views.sites(spark, sf), views.page_states(spark, sf))


@query("SELECT id, url FROM state_v ORDER BY id LIMIT 100")
def report_cap(spark, sf):
    return reports.report_pages(views.page_states(spark, sf), 100).select("id", "url")


@query("SELECT l_orderkey, l_partkey, count(*)::BIGINT AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, sf):
    return integrity.check_unique(views.table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query(
    """SELECT o_custkey AS value, count(*)::BIGINT AS rows FROM orders
    WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY o_custkey"""
)
def check_fk(spark, sf):
    return integrity.check_fk(views.table(spark, sf, "orders"), "o_custkey", views.table(spark, sf, "supplier"), "s_suppkey")


@query(
    """SELECT doc_id AS id, 'text' AS "column", length(text)::INTEGER AS length FROM documents WHERE length(text) > 500
    UNION ALL SELECT doc_id, 'lang', length(lang)::INTEGER FROM documents WHERE length(lang) > 20"""
)
def check_lengths(spark, sf):
    return integrity.check_lengths(views.table(spark, sf, "documents"), {"text": 500, "lang": 20}, "doc_id")


@query(
    """SELECT coalesce(code, 'A') AS value, count(*)::BIGINT AS rows FROM (SELECT CASE WHEN content_type = 'application/pdf' THEN 'PDF' ELSE 'A' END AS code
    FROM fetch_v) WHERE code NOT IN ('PDF', 'DOC', 'DOCX', 'PPT', 'PPTX') GROUP BY 1"""
)
def check_codes(spark, sf):
    mime = F.when(F.col("content_type") == "application/pdf", F.col("content_type")).otherwise("a")
    coded = views.fetch_log(spark, sf).select(responses.data_type_code(mime).alias("data_type_code"))
    return integrity.check_codes(coded, "data_type_code", DATA_TYPES)


@query("SELECT page_type_code AS value, count(*)::BIGINT AS rows FROM state_v WHERE page_type_code = 'ERROR' GROUP BY 1")
def check_page_types(spark, sf):
    return integrity.check_codes(views.page_states(spark, sf), "page_type_code", [c for c in PAGE_TYPES if c != "ERROR"])
