import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webgraph_spark.functions import markup
from webgraph_spark.operators import contents, extract
from webgraph_spark.sources import published, sitemaps

T0 = dt.datetime(2024, 1, 1)


def _links(spark, *edges):
    return spark.createDataFrame(list(edges), "from_page bigint, to_page bigint")


def _read(spark, base, **options):
    return sorted((r.from_page, r.to_page) for r in published.read_published(spark, base, "link", **options).collect())


def test_batches_appear_whole_and_once(spark, tmp_path):
    base = str(tmp_path / "t")
    assert _read(spark, base) == []
    published.commit(spark, {"link": _links(spark, (1, 2))}, base, "a")
    published.commit(spark, {"link": _links(spark, (3, 4), (5, 6))}, base, "b")
    version = published.commit(spark, {"link": _links(spark, (1, 2), (7, 8))}, base, "a")
    assert version == 3
    assert _read(spark, base) == [(1, 2), (3, 4), (5, 6), (7, 8)]
    assert _read(spark, base, version=1) == [(1, 2)]
    assert _read(spark, base, without="b") == [(1, 2), (7, 8)]


def test_writer_that_dies_before_the_rename_leaves_nothing_to_read(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    published.commit(spark, {"link": _links(spark, (1, 2))}, base, "a")
    with monkeypatch.context() as broken:
        broken.setattr(published, "_add_version", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            published.commit(spark, {"link": _links(spark, (9, 9)), "site": spark.createDataFrame([(1, "d")], "id bigint, domain string")}, base, "b")
    assert _read(spark, base) == [(1, 2)]
    assert published.read_published(spark, base, "site").count() == 0
    assert published.vacuum(spark, base, older_than=3600) == []
    assert sorted(f.split("/")[1] for f in published.vacuum(spark, base, older_than=-3600)) == ["link", "site"]
    published.commit(spark, {"link": _links(spark, (9, 9))}, base, "b")
    assert _read(spark, base) == [(1, 2), (9, 9)]


def test_two_writers_keep_both_batches(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    first, second = (published.stage({"link": _links(spark, edge)}, base, name) for name, edge in [("a", (1, 2)), ("b", (3, 4))])
    seen, real = [], published.manifest

    def late(spark, base):
        found = real(spark, base)
        if not seen:
            # The other writer publishes between this one's reading and its rename.
            seen.append(1)
            published.publish(spark, base, "a", first)
        return found

    monkeypatch.setattr(published, "manifest", late)
    assert published.publish(spark, base, "b", second) == 2
    assert _read(spark, base) == [(1, 2), (3, 4)]


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_path):
    base = str(tmp_path / "t")
    for n in range(4):
        published.commit(spark, {"link": _links(spark, (n, n))}, base, "a")
    assert len(published.vacuum(spark, base, keep=2, older_than=-3600)) == 2
    assert _read(spark, base) == [(3, 3)] and _read(spark, base, version=3) == [(2, 2)]


def _fetches(spark):
    png, pdf = "image/png", "application/pdf"
    rows = [
        (1, "http://a/x/1.png", 200, png, bytearray(b"x" * 40), None, True, 1),
        (2, "http://a/2.png", 200, png, bytearray(b"x" * 70), None, True, 2),
        (3, "http://a/3.png", 200, png, bytearray(b"x" * 59), None, True, 3),
        (4, "http://a/4.png", 404, png, bytearray(b"x"), None, True, 4),
        (5, "http://a/5.png", 200, png, None, None, True, 5),
        (6, "http://a/6.png", 200, png, bytearray(b"x"), None, False, 6),
        (7, "http://a/7", 200, pdf, bytearray("é".encode()), None, True, 7),
        (8, "http://a/8", 200, "application/pdf; x", bytearray(b"x"), None, True, 8),
        (9, "http://a/9.png", 200, png, bytearray(b""), None, True, 9),
    ]
    schema = "page_id bigint, url string, status int, content_type string, body binary, error string, robots_ok boolean, _ord bigint"
    return spark.createDataFrame(rows, schema).withColumn("accessed_time", F.lit(T0)).withColumn("html", F.lit(None).cast("string"))


def test_bodies_within_the_budget(spark):
    images = contents.image_rows(_fetches(spark), limit=100).orderBy("page_id").collect()
    assert [(r.page_id, r.filename, r.data_size, len(r.data)) for r in images] == [(1, "1.png", 40, 40), (3, "3.png", 59, 59), (9, "9.png", 0, 0)]
    assert [r.page_id for r in contents.image_rows(_fetches(spark), limit=100, stored=60).orderBy("page_id").collect()] == [9]
    data = contents.page_data_rows(_fetches(spark)).collect()
    assert [(r.page_id, r.data_type_code, r.data_size) for r in data] == [(7, "PDF", 2)]
    assert contents.image_rows(_fetches(spark).limit(0)).count() == 0


def test_site_rows_keep_the_last_sitemap(spark):
    sites = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, domain string")
    files = spark.createDataFrame(
        [("a", 200, "text/plain", "R"), ("b", 200, "text/html", "R"), ("c", 404, "text/plain", "R")],
        "domain string, status int, content_type string, body string",
    )
    maps = spark.createDataFrame([("a", 1, 200, "x"), ("a", 2, 200, "y"), ("b", 1, 200, "x"), ("b", 2, 404, "y")], "domain string, pos int, status int, body string")
    found = contents.site_rows(sites, files, maps).orderBy("id").collect()
    assert [(r.robots_content, r.sitemap_content) for r in found] == [("R", "y"), (None, None), (None, None)]
    assert contents.site_rows(sites, files).where("sitemap_content is null").count() == 3


def test_large_sitemap_is_split_over_tasks(spark, tmp_path):
    folder = tmp_path / "m" / "site_id=7"
    folder.mkdir(parents=True)
    size = 200_000
    body = "".join(f"<url><loc>http://a/{i}?x&amp;y</loc></url>" for i in range(size))
    (folder / "a.xml").write_text(f"<?xml version='1.0'?><urlset>{body}</urlset>")
    (folder / "b.xml").write_text("﻿<urlset><LOC>http://b/1</LOC>\n<loc>http://b/2</loc><loc>http://b/cut")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        assert spark.read.option("lineSep", "<loc>").text(str(tmp_path / "m")).select(F.spark_partition_id()).distinct().count() > 4
        found = sitemaps.read_sitemap_files(spark, str(tmp_path / "m"))
        assert found.count() == size + 2
        places = found.where("pos < 200000")
        assert places.where(F.col("loc") != F.concat(F.lit("http://a/"), F.col("pos").cast("string"), F.lit("?x&y"))).count() == 0
        assert [r.loc for r in found.where("pos >= 200000").orderBy("pos").collect()] == ["http://b/1", "http://b/2"]
    finally:
        spark.conf.set(name, before)


SIGNS = ['<a href="/x">', "<a title='>' href='/y'>", '<a href="/z', "<!-- c -->", "<!-->", "<!-- ", "text", '">', "<p class=\"k\">", "<b>"]


def test_plain_markup_stays_with_the_patterns(spark):
    plain = ['<a href="/x" title="y">t</a>', "<script>if (a > b) {}</script>", "<!-- <a href='x> -->", None, "", "a < b > c", "<p>1 > 0</p>"]
    odd = ["<a title='a > b' href='/x'>", '<a href="/x>t</a>', "<!-- open", "<!--> x", "<SCRIPT> open", "<img/src=x>", "<a alt=\" href=x\">"]
    rows = spark.createDataFrame([(t,) for t in plain + odd], "html string").select(markup.misread(F.col("html"))).collect()
    assert [r[0] for r in rows[: len(plain)]] == [False, False, True, False, False, False, False]
    assert all(r[0] for r in rows[len(plain) :])


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=6), min_size=60, max_size=60))
def test_routing_gives_the_tokenizers_links(spark, pages):
    rows = [(i, "http://h.example/", "".join(parts)) for i, parts in enumerate(pages)]
    df = spark.createDataFrame(rows, "id bigint, url string, html_content string")
    found = {}
    for r in extract.page_candidates(df).where("kind = 'a'").orderBy("from_page", "pos").collect():
        found.setdefault(r.from_page, []).append(r.to_url)
    for i, _, html in rows:
        want = [href for href in extract._read_page(html)["hrefs"] if href]
        assert len(found.get(i, [])) == len(want), html
