from collections import Counter

from pyspark.sql import functions as F

from webgraph_spark.functions import markup, shingles
from webgraph_spark.operators import crawl, extract


def _pages(spark, html, url="http://a.gov.si/x"):
    return spark.createDataFrame([(1, url, html)], "id bigint, url string, html_content string")


def _targets(found):
    return [r.to_url for r in found.orderBy("pos").collect()]


def test_script_links(spark):
    html = "<script>location='http://č.gov.si/pot/ž?x=1#a'; b=\"https://a.b.c/d.\"; http://nodot/</script>"
    raw = _pages(spark, html).select(markup.script_urls(F.col("html_content")).alias("u")).first().u
    assert raw == ["http://č.gov.si/pot/ž?x=1#a", "https://a.b.c/d"]
    assert _targets(extract.extract_script_links(_pages(spark, html))) == [
        "http://%C4%8D.gov.si/pot/%C5%BE?x=1", "https://a.b.c/d",
    ]


def test_links_skip_comments_scripts_and_decode_entities(spark):
    html = """<!-- <a href="/no">n</a> --><script>"<a href='/no'>"</script>
    <A class=x HREF='/p?a=1&amp;b=2'>y</A><a href=q>z</a><a name="n">w</a><a href="#t">t</a>"""
    assert _targets(extract.extract_links(_pages(spark, html))) == ["http://a.gov.si/p?a=1&b=2", "http://a.gov.si/q"]


def test_images(spark):
    html = '<img src="/i/x.png?v=1#f"><img alt="" src="data:image/png;base64,AA"><img>'
    assert _targets(extract.extract_images(_pages(spark, html))) == ["http://a.gov.si/i/x.png?v=1#f"]


def test_sitemap(spark):
    xml = "<urlset><url><loc>http://a.gov.si/x</loc></url><url><loc>/y</loc></url></urlset>"
    maps = spark.createDataFrame([(1, "http://a.gov.si/", xml)], "from_page bigint, url string, content string")
    assert _targets(extract.extract_sitemap_urls(maps)) == ["http://a.gov.si/x", "http://a.gov.si/y"]


def test_admissible(spark):
    rows = [("http://x.gov.si/",), ("http://gov.si/",), ("http://x.gov.si/" + "a" * 2000,)]
    assert extract.admissible(spark.createDataFrame(rows, "to_url string")).count() == 1


def test_text_and_tokenizer_agree(spark):
    html = "<style>p{}</style><p>a&eacute;&#233;&#x1F600;</p><p>&amp;lt; &bogus; &amp x&lt</p><!-- c --><script>s</script>"
    pages = _pages(spark, html)
    text = pages.select(markup.strip_markup(F.col("html_content")).alias("t")).first().t
    assert text == "aéé😀&lt; &bogus; & x<"
    token = extract.tokenize_pages(pages).first()
    assert token.text == text and token.scripts == ["s"]
    quoted = _pages(spark, '<a title="a>b" href="/q">x</a>')
    assert (extract.tokenize_pages(quoted).first().text, extract.tokenize_pages(quoted).first().hrefs) == ("x", ["/q"])


def test_words_split_like_unicode_white_space(spark):
    text = "a b c\x1cd\x85e  f\n"
    assert _pages(spark, text).select(shingles.words(F.col("html_content")).alias("w")).first().w == text.split()


def test_shingles_of_short_and_long_texts(spark):
    rows = [(1, "a b"), (2, "a b c d"), (3, "a a a a a")]
    frame = spark.createDataFrame(rows, "id int, t string")
    found = frame.select("id", shingles.word_shingles(F.col("t"), 3).alias("s"), shingles.shingle_set(F.col("t"), 3).alias("h"))
    got = {r.id: (r.s, r.h) for r in found.collect()}
    assert got[1] == ([], [])
    assert got[2][0] == ["a b c", "b c d"] and len(got[2][1]) == 2
    assert got[3][0] == ["a a a"] * 3 and len(got[3][1]) == 1


def test_classification(spark):
    rows = [
        (False, None, 200, "text/html", "h", False), (True, "timeout", None, None, None, None),
        (True, None, 404, "text/html", "h", False), (True, None, 200, "text/html; charset=utf-8", None, False),
        (True, None, 200, "text/html", "h", True), (True, None, 200, "text/html", "h", False),
        (True, None, 200, "image/png", None, None), (True, None, 200, "application/pdf", None, None),
        (True, None, 200, "application/pdf; charset=x", None, None), (True, None, 200, None, None, None),
    ]
    schema = "page_id int, robots_ok boolean, error string, status int, content_type string, html string, duplicate boolean"
    fetches = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    fetches = fetches.withColumn("site_id", F.lit(1)).withColumn("accessed_time", F.lit(None).cast("timestamp_ntz"))
    found = crawl.classify_response(fetches).orderBy("page_id").collect()
    assert [(r.page_type_code, r.http_status_code, r.data_type_code) for r in found] == [
        ("DISALLOWED", 500, None), ("ERROR", 500, None), ("ERROR", 500, None), ("ERROR", 500, None),
        ("DUPLICATE", 200, None), ("HTML", 200, None), ("IMAGE", 200, None), ("BINARY", 200, "PDF"),
        ("BINARY", 200, None), ("BINARY", 200, None),
    ]
    assert [(r.html_content, r.hash_content is not None) for r in found[4:6]] == [(None, True), ("h", True)]


def test_markup_that_browsers_read_otherwise(spark):
    html = (
        'A<!-- <script>var u="http://hidden.example.org/";</script> -->B<script>x="http://seen.example.org/a"</script>C'
        '<a href="/p?a=1&section=2&region=3&copy=4&amp;b=5&lt;">&#146;&#99999999999;&copy2</a>'
    )
    page = spark.createDataFrame([(html,)], "html string")
    row = page.select(
        markup.strip_markup(F.col("html")).alias("text"),
        markup.hrefs(F.col("html")).alias("hrefs"),
        markup.script_urls(F.col("html")).alias("urls"),
    ).first()
    assert row.text == "ABC\u2019\ufffd\u00a92"
    assert row.hrefs == ["/p?a=1&section=2&region=3&copy=4&b=5<"]
    assert row.urls == ["http://seen.example.org/a"]


def test_shingles_are_counted_through_runs(spark):
    """Repeated windows count once a row; what is moved is far less than all windows."""
    texts = ["a b c a b c a b c d", "x a b c d", None, "", "a b", "a a a a a", "a b c a b c a b c d", " ".join(map(str, range(300)))]
    expected = Counter(" ".join(w) for t in texts if t for w in {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)})
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = shingles.shingle_counts(frame, "t", 4, 3).collect()
    assert {r.shingle: r.pages for r in found} == expected and len(found) == len(expected)
    text = texts[-1].encode()
    runs = shingles._runs(text, 10)
    assert sum(len(run.split()) - 9 for _, run in runs) == 291
    assert sum(len(run) for _, run in runs) < 4 * len(text)
