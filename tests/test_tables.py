import datetime as dt
import glob
import json
import random

from pyspark.sql import functions as F

from webgraph_spark.operators import claims, crawl, frontier, integrity, links, ordering, politeness
from webgraph_spark.plans import crawl_round, reports
from webgraph_spark.schemas import Limits
from webgraph_spark.sources import bucketed, seeds, sinks, tables

T0 = dt.datetime(2024, 1, 1)


def _queue(spark):
    rows = [
        (1, "http://a/x", "FRONTIER", None, None),
        (2, "http://a/%C4%8D", "FRONTIER", T0 + dt.timedelta(seconds=2), None),
        (3, "http://b/y", "FRONTIER", T0 + dt.timedelta(seconds=1), None),
        (4, "http://a/z", "FRONTIER", T0, True),
        (5, "http://a/w", "HTML", T0, None),
        (6, "http://a/v", None, T0, None),
    ]
    schema = "id bigint, url string, page_type_code string, added_at_time timestamp_ntz, active_in_crawler boolean"
    return spark.createDataFrame(rows, schema)


def test_queue(spark):
    taken = frontier.next_from_frontier(_queue(spark), 5).collect()
    assert [(r.id, r.url, r.active_in_crawler) for r in taken] == [
        (3, "http://b/y", True), (2, "http://a/č", True), (1, "http://a/x", True),
    ]
    assert sorted(r.id for r in frontier.next_per_site(_queue(spark), 1).collect()) == [2, 3]
    assert sorted(r.id for r in tables.scan_crawled_pages(_queue(spark)).collect()) == [5]
    assert crawl.reset_active(_queue(spark)).where("active_in_crawler").count() == 0


def test_row_cap_refuses_the_whole_batch(spark):
    batch = spark.createDataFrame([(1, "u")], "from_page bigint, to_url string")
    assert frontier.row_cap(batch, spark.range(3), 3).count() == 1
    assert frontier.row_cap(batch, spark.range(4), 3).count() == 0


def test_admission_twice_adds_nothing(spark):
    pages = spark.createDataFrame([(1, "u1"), (7, "u2")], "id bigint, url string")
    found = [(1, "u2", 0), (1, "new", 1), (7, "new", 0), (7, "u2", 1), (7, "u2", 2)]
    candidates = spark.createDataFrame(found, "from_page bigint, to_url string, pos int")
    created, edges = frontier.resolve_candidates(candidates, pages)
    assert [tuple(r) for r in created.collect()] == [(8, "new")]
    assert sorted(map(tuple, edges.collect())) == [(1, 7), (1, 8), (7, 7), (7, 8)]
    again, same = frontier.resolve_candidates(candidates, pages.unionByName(created))
    assert again.count() == 0 and links.new_links(same, edges).count() == 0


def test_seeds(spark, tmp_path):
    path = tmp_path / "seeds.txt"
    path.write_text("http://a.si\n# note\nhttp://b.si/#x\n  http://c.si/  \nhttp://a.si\n")
    assert sorted(r.url for r in seeds.read_seeds(spark, str(path)).collect()) == ["http://a.si", "http://c.si/"]


def test_politeness(spark):
    rows = [(i, 1, T0 + dt.timedelta(seconds=s)) for i, s in enumerate([0, 4, 20])]
    fetches = spark.createDataFrame(rows, "page_id bigint, site_id bigint, accessed_time timestamp_ntz")
    delays = spark.createDataFrame([(1, 10)], "site_id bigint, crawl_delay int")
    found = politeness.politeness_audit(fetches, delays).orderBy("page_id").collect()
    assert [(r.wait, r.slept, r.violation) for r in found] == [(0.0, 0, False), (6.0, 10, True), (0.0, 0, False)]


def test_previous_fetch_of_one_hot_site_over_many_ranges(spark, many_ranges):
    site = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40)
    moment = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 7919 % 6000)
    fetches = spark.range(6000).select(F.col("id").alias("page_id"), site.alias("site_id"), moment.alias("accessed_time"))
    ranged = ordering.in_ranges(fetches, ["site_id", "accessed_time", "page_id"])
    assert ranged.where("site_id = 1").select(ordering.RANGE).distinct().count() > 1
    found = {r.page_id: r.last_crawled_at for r in politeness.previous_fetch(fetches).collect()}
    last, expected = {}, {}
    for r in sorted(fetches.collect(), key=lambda r: (r.accessed_time, r.page_id)):
        expected[r.page_id] = last.get(r.site_id)
        last[r.site_id] = r.accessed_time
    assert found == expected


def _graph(spark):
    sites = spark.createDataFrame([(1, "http://a/"), (2, "http://b/"), (3, "http://c/")], "id bigint, domain string")
    pages = spark.createDataFrame(
        [(i, 1 if i % 3 else 2, f'http://x/"{i}é', "HTML" if i % 2 else None) for i in range(40)] + [(99, None, "q", "FRONTIER")],
        "id bigint, site_id bigint, url string, page_type_code string",
    )
    return sites, pages


def test_site_tree_files_are_one_document(spark, many_ranges, tmp_path):
    sites, pages = _graph(spark)
    path = str(tmp_path / "tree")
    sinks.write_site_tree(sites, pages, path)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))
    tree = json.loads(text)
    assert tree["name"] == "Sites" and [s["name"] for s in tree["children"]] == ["http://a/", "http://b/", "http://c/"]
    assert [len(s["children"]) for s in tree["children"]] == [26, 14, 0]
    assert tree["children"][1]["children"][0] == {"name": 'http://x/"0é', "type": None, "size": 5, "children": []}


def test_site_tree_parts_hold_every_page_once(spark):
    sites, pages = _graph(spark)
    parts = reports.site_tree(sites, pages, children_per_row=5).collect()
    assert sorted(c.id for r in parts for c in r.children) == list(range(40))
    assert len([r for r in parts if r.name == "http://a/"]) > 1
    assert [len(r.children) for r in parts if r.name == "http://c/"] == [0]


def test_link_report(spark, tmp_path):
    sites, pages = _graph(spark)
    edges = spark.createDataFrame([(1, 0), (0, 1), (2, 2), (99, 1)], "from_page bigint, to_page bigint")
    report = reports.domain_link_report(edges, pages, sites, "http://a/")
    sinks.write_link_edges(report, str(tmp_path / "links"))
    rows = spark.read.json(str(tmp_path / "links")).orderBy("source").collect()
    assert [(r.source, r.target, r.weight, r.type) for r in rows] == [
        ('http://x/"1é', 'http://x/"0é', 1, ""), ('http://x/"2é', 'http://x/"2é', 1, ""),
    ]


def test_integrity(spark):
    sites, pages = _graph(spark)
    assert integrity.check_unique(pages, ["site_id"]).count() == 2
    assert [tuple(r) for r in integrity.check_fk(pages, "site_id", sites.where("id = 1"), "id").collect()] == [(2, 14)]
    assert integrity.check_lengths(pages, integrity.widths_of("page")).count() == 0
    found = integrity.check_codes(pages, "page_type_code", ["HTML"]).collect()
    assert [tuple(r) for r in found] == [("FRONTIER", 1)]


def test_crawl_round(spark):
    words = " ".join(f"w{i}" for i in range(400))
    link = '<a href="/n">n</a><a href="http://out.si/x">o</a><img src="/i.png">'
    bodies = [f"<p>{words}</p>{link}", f"<p>{words}</p>{link}", f"<p>{words} more</p>{link}", None, "<p>new</p>" + link]
    rows = [(i, i, 1, f"http://a.gov.si/{i}", True, None, 200, "text/html", b) for i, b in enumerate(bodies)]
    rows.append((5, 5, 1, "http://a.gov.si/5", False, None, 200, "text/html", "x"))
    schema = (
        "page_id bigint, ord bigint, site_id bigint, url string, robots_ok boolean, error string, status int,"
        " content_type string, html string"
    )
    fetches = spark.createDataFrame(rows, schema).withColumn("accessed_time", F.lit(T0).cast("timestamp_ntz"))
    pages = fetches.select(F.col("page_id").alias("id"), "url")
    stored = spark.createDataFrame([(0, 6)], "from_page bigint, to_page bigint")
    done = crawl_round.crawl_round(fetches, pages, stored, Limits())
    kinds = {r.page_id: r.page_type_code for r in done.results.collect()}
    assert [kinds[i] for i in range(6)] == ["HTML", "DUPLICATE", "DUPLICATE", "ERROR", "HTML", "DISALLOWED"]
    assert sorted(map(tuple, done.created.collect())) == [(6, "http://a.gov.si/n"), (7, "http://a.gov.si/i.png")]
    assert sorted(map(tuple, done.edges.collect())) == [(0, 7), (4, 6), (4, 7)]
    assert {r.id: r.hash_length for r in done.signatures.collect()} == {0: 391}
    again = fetches.where("page_id <= 2").withColumns({"page_id": F.col("page_id") + 10, "ord": F.col("ord") + 10})
    later = crawl_round.crawl_round(again, pages, stored, Limits(), done.hashes, done.signatures)
    assert {r.page_id: r.page_type_code for r in later.results.collect()} == {10: "DUPLICATE", 11: "DUPLICATE", 12: "DUPLICATE"}


def test_row_caps_and_times_of_a_round(spark):
    rows = [(1, 1, T0, True), (2, 1, T0 + dt.timedelta(seconds=1), False), (3, 1, T0 + dt.timedelta(seconds=4), True)]
    fetches = spark.createDataFrame(rows, "page_id bigint, site_id bigint, accessed_time timestamp_ntz, robots_ok boolean")
    delays = spark.createDataFrame([(1, 10)], "site_id bigint, crawl_delay int")
    sites = spark.createDataFrame([(1, T0 - dt.timedelta(seconds=3))], "id bigint, last_crawled_at timestamp_ntz")
    found = politeness.politeness_audit(fetches, delays, sites).orderBy("page_id").collect()
    assert [(r.page_id, r.wait) for r in found] == [(1, 7.0), (3, 6.0)]
    newer = sites.withColumn("last_crawled_at", F.lit(T0 + dt.timedelta(days=1)).cast("timestamp_ntz"))
    assert crawl.update_sites(newer, fetches).first().last_crawled_at == T0 + dt.timedelta(days=1)


def test_schedule_equals_sequential_form(spark, many_ranges):
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, rng.choice([1, 1, 1, 2, 3]), t0 + dt.timedelta(microseconds=rng.randrange(400_000_000))) for i in range(600)]
    fetches = spark.createDataFrame(rows, "page_id bigint, site_id bigint, accessed_time timestamp_ntz")
    delays = spark.createDataFrame([(1, 2), (2, None)], "site_id bigint, crawl_delay int")
    found = {r.page_id: r.wait for r in politeness.politeness_schedule(fetches, delays).collect()}
    last, want = {}, {}
    for page, site, at in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        delay = dt.timedelta(seconds={1: 2}.get(site, 0))
        start = max(at, last[site] + delay) if site in last else at
        last[site], want[page] = start, (start - at) // dt.timedelta(microseconds=1)
    assert found == want and max(want.values()) > 0


def test_stored_side_stays_in_its_buckets(spark):
    pages = spark.range(500).select("id", F.concat(F.lit("http://h/"), "id").alias("url"))
    candidates = spark.range(400, 700).select(F.lit(1).alias("from_page"), F.concat(F.lit("http://h/"), "id").alias("to_url"), F.col("id").alias("pos"))
    name = bucketed.write_bucketed(pages, ["url"], 16)
    firsts = candidates.select(F.col("to_url").alias("url"), "from_page", "pos")
    absent = frontier.admit_unique(firsts, bucketed.read_bucketed(spark, name), ["url"], ["pos"], 16)
    plan = absent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert absent.count() == 200
    found = frontier.new_pages(candidates, bucketed.read_bucketed(spark, name), 16)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, frontier.new_pages(candidates, pages).collect()))


def test_claims(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [(1, 7, "a", at(0), 10), (2, 7, "b", at(5), 10), (3, 7, "a", at(9), 10), (4, 7, "b", at(10), 10), (5, 7, "a", at(10), 10),
            (6, 8, "b", at(3), None), (7, 8, "a", at(10**6), 5), (8, None, "a", at(0), 5), (9, 9, "a", None, 5)]
    log = spark.createDataFrame(rows, "claim_id bigint, page_id bigint, taker string, at timestamp_ntz, lease int")
    assert {r.claim_id for r in claims.fold_claims(log).where("won").collect()} == {1, 4, 6}
    held = lambda s: {tuple(r) for r in claims.held_pages(log, F.lit(at(s)).cast("timestamp_ntz")).collect()}
    assert held(2) == {(7, "a")} and held(9) == {(7, "a"), (8, "b")} and held(12) == {(7, "b"), (8, "b")} and held(25) == {(8, "b")}
    pages = claims.with_claims(_queue(spark).withColumn("id", F.col("id") + 6), log, F.lit(at(12)).cast("timestamp_ntz"))
    # Pages 7 and 8 are held; the flag of the old table no longer counts.
    assert {r.id for r in frontier.frontier_ready(pages).collect()} == {9, 10}
