import pytest
from pyspark.sql import functions as F

from webgraph_spark.operators import robots

CASES = [
    ("User-agent: *\nDisallow: /a\nAllow: /a/b", {"/a/b": False, "/c": True}, None),
    ("User-agent: *\nAllow: /a/b\nDisallow: /a", {"/a/b": True, "/a": False}, None),
    ("User-agent: *\nDisallow:", {"/a": True}, None),
    ("User-agent: *\n\nDisallow: /", {"/a": True}, None),
    ("User-agent: x\nDisallow: /\nUser-agent: *\nCrawl-delay: 7", {"/a": True}, 7),
    ("User-agent: *\nCrawl-delay: 0.5\nDisallow: /", {"/": False}, None),
    ("User-agent: *\nDisallow: /*.pdf$", {"/a.pdf": True}, None),
    ("User-agent: *\nDisallow: /a\n\nUser-agent: *\nDisallow: /b", {"/a": False, "/b": True}, None),
    ("Disallow: /\nSitemap: http://h/s.xml", {"/": True}, None),
    (None, {"/a": True}, None),
    ("User-agent: *\r\n# note\r\n  \r\nDISALLOW : /č # x\r\nCrawl-delay: 3", {"/č": False, "/c": True}, 3),
    ("User-agent:\nDisallow: /\n\nUser-agent: *\nAllow: /", {"/a": False}, None),
]


def _sites(spark):
    return spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(CASES)], "site_id bigint, robots_content string")


def test_decisions_and_delays(spark):
    rules = robots.robots_rules(_sites(spark))
    asked = [(i, f"http://h{path}", allowed) for i, (_, paths, _) in enumerate(CASES) for path, allowed in paths.items()]
    targets = spark.createDataFrame(asked, "site_id bigint, url string, expected boolean")
    wrong = [tuple(r) for r in robots.robots_decision(targets, rules).where("allowed <> expected").collect()]
    assert wrong == []
    delays = {r.site_id: r.crawl_delay for r in robots.robots_crawl_delay(rules).collect()}
    assert [delays.get(i) for i in range(len(CASES))] == [delay for _, _, delay in CASES]


def test_sitemaps_and_request_rate(spark):
    sites = spark.createDataFrame(
        [(1, "Disallow: /\nSitemap: http://h/s.xml\nUser-agent: bot\nRequest-rate: 3/10\nsitemap: http://h/t%20u")],
        "site_id bigint, robots_content string",
    )
    assert [tuple(r) for r in robots.sitemap_list(sites).orderBy("pos").collect()] == [
        (1, 1, "http://h/s.xml"), (1, 2, "http://h/t u"),
    ]
    rules = robots.robots_rules(sites)
    assert robots.robots_request_rate(rules).count() == 0
    assert tuple(robots.robots_request_rate(rules, "MyBot/2").first().request_rate) == (3, 10)


@pytest.mark.parametrize("status,mime,usable", [(200, "text/plain; x", 1), (200, "text/html", 0), (404, "text/plain", 0)])
def test_usable_files(spark, status, mime, usable):
    fetches = spark.createDataFrame([(status, mime)], "status int, content_type string")
    assert robots.robots_file_usable(fetches).count() == usable
    assert robots.sitemap_file_usable(fetches).count() == int(status == 200)


def test_numbers_too_large_are_unknown(spark):
    sites = spark.createDataFrame([(1, "User-agent: *\nRequest-rate: 99999999999/1\nDisallow: /a")], "site_id long, robots_content string")
    rate = robots.robots_rules(sites).first().request_rate
    assert rate.requests is None and rate.seconds == 1


def test_very_many_rules_on_one_site(spark):
    lines = ["User-agent: *"] + [f"{('Disallow', 'Allow')[i % 2]}: /d{i % 50_000}/{'x' * (i % 7)}" for i in range(50_000)]
    sites = spark.createDataFrame([(1, chr(10).join(lines)), (2, "User-agent: *" + chr(10) + "Disallow: *")], "site_id bigint, robots_content string")
    rules = robots.robots_rules(sites)
    rows = [(1, f"http://h/d{i}/{'x' * 9}") for i in range(0, 50_000, 97)] + [(1, "http://h/none"), (2, "http://h/a"), (None, "http://h/b"), (3, "http://h/c")]
    targets = spark.createDataFrame(rows, "site_id bigint, url string")
    found = {(r.site_id, r.url): r.allowed for r in robots.robots_decision(targets, rules).collect()}
    want = {(1, f"http://h/d{i}/{'x' * 9}"): i % 2 == 1 for i in range(0, 50_000, 97)}
    assert found == {**want, (1, "http://h/none"): True, (2, "http://h/a"): True, (None, "http://h/b"): True, (3, "http://h/c"): True}
    assert max(r.n for r in robots.prefix_index(rules).groupBy(F.length("prefix")).agg(F.count(F.lit(1)).alias("n")).collect()) > 5000
