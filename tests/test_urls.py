import urllib.parse

import pytest
from pyspark.sql import functions as F

from webgraph_spark.functions import urls

SITE = "http://a.gov.si/"

LINKS = [
    (None, None), ("", None), ("/", None), ("#top", None), ("javascript:go()", None), ("mailto:x@y.si", None),
    ("tel:1", None), ("/p/q#z", "http://a.gov.si/p/q"), ("p", "http://a.gov.si/p"),
    ("//cdn.si/x", "http://a.gov.si//cdn.si/x"), ("www.b.gov.si", "http://a.gov.si/http://www.b.gov.si"),
    ("HTTP://b.si/", "http://a.gov.si/HTTP://b.si/"), ("http://b.si/a b,é", "http://b.si/a%20b%2C%C3%A9"),
    ("http://b.si/a%20b", "http://b.si/a%2520b"),
]

AWKWARD = ["a b", "é/ž?x=1&y=+", "%20 %zz %253A", "[x]*~'()!$,;@", "日本 😀", "a%", "%C3%A9"]


def _one(spark, values, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in frame.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_canonical_link(spark):
    found = _one(spark, [h for h, _ in LINKS], lambda v: urls.canonical_link(v, F.lit(SITE)))
    assert found == [expected for _, expected in LINKS]


def test_fix_www(spark):
    found = _one(spark, ["www.b.gov.si"], lambda v: urls.canonical_link(v, F.lit(SITE), fix_www=True))
    assert found == ["http://www.b.gov.si"]


def test_percent_encode_and_decode(spark):
    encoded = _one(spark, AWKWARD, urls.percent_encode)
    assert encoded == [urllib.parse.quote(v, ":/-_.~&?+=") for v in AWKWARD]
    assert _one(spark, encoded, urls.percent_decode) == AWKWARD
    assert _one(spark, AWKWARD, urls.percent_decode) == [urllib.parse.unquote(v) for v in AWKWARD]


@pytest.mark.parametrize(
    "url,expected",
    [("http://x.gov.si/", True), ("http://gov.si/", False), ("http://x.gov.si.evil.com/", True), ("http://x.si/?u=.gov.si", False)],
)
def test_in_scope(spark, url, expected):
    assert _one(spark, [url], urls.in_scope) == [expected]


def test_origin(spark):
    given = ["HTTP://User@Host.si:80/x?y#z", "https://h", "http://h?q", "nothing"]
    assert _one(spark, given, urls.origin) == ["http://User@Host.si:80/", "https://h/", "http://h/", ":///"]


def test_images(spark):
    given = ["/i/x.png?v=1#f", "data:image/png;base64,AA", None, "http://b.si/y.png"]
    assert _one(spark, given, lambda v: urls.canonical_image(v, F.lit(SITE))) == [
        "http://a.gov.si/i/x.png?v=1#f", None, None, "http://b.si/y.png",
    ]
    assert _one(spark, ["http://a.gov.si/i/x.png?v=1#f"], urls.image_filename) == ["x.png?v=1#f"]


def test_robots_path(spark):
    given = ["http://h", "http://h/a?x=1", "http://h/a%2520b", "http://h/a?", "http://h/č;#"]
    assert _one(spark, given, urls.robots_path) == ["/", "/a%3Fx%3D1", "/a%2520b", "/a", "/%C4%8D"]
