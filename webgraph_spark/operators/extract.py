"""Link, image and sitemap extraction over page tables (EXT-1..5, SET-1)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions import markup, urls
from webgraph_spark.operators.skew import spread_join
from webgraph_spark.schemas import LIMITS


def _candidates(pages: DataFrame, values: Column, kind: str, to_url) -> DataFrame:
    # One row per page and value; pos keeps the order inside the page.
    found = pages.select("id", "url", F.posexplode(values).alias("pos", "_value"))
    return found.select(
        F.col("id").alias("from_page"),
        to_url(F.col("_value"), urls.origin(F.col("url"))).alias("to_url"),
        F.lit(kind).alias("kind"),
        "pos",
    ).where(F.col("to_url").isNotNull())


def extract_links(pages: DataFrame, fix_www: bool = False) -> DataFrame:
    """Targets of ``<a href>``; pages has id, url, html_content."""
    return _candidates(
        pages, markup.hrefs(F.col("html_content")), "a", lambda v, site: urls.canonical_link(v, site, fix_www)
    )


def extract_images(pages: DataFrame) -> DataFrame:
    return _candidates(pages, markup.image_sources(F.col("html_content")), "img", urls.canonical_image)


def extract_script_links(pages: DataFrame) -> DataFrame:
    return _candidates(pages, markup.script_urls(F.col("html_content")), "script", urls.canonical_link)


def extract_sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """Entries of sitemap files; sitemaps has from_page, url (any of the site), content."""
    found = sitemaps.select("from_page", "url", F.posexplode(markup.sitemap_locations(F.col("content"))).alias("pos", "_loc"))
    return found.select(
        "from_page",
        urls.canonical_link(F.col("_loc"), urls.origin(F.col("url"))).alias("to_url"),
        F.lit("sitemap").alias("kind"),
        "pos",
    ).where(F.col("to_url").isNotNull())


# The order in which the targets of one page are admitted.
KIND_ORDER = ["sitemap", "a", "script", "img"]


def all_candidates(*parts: DataFrame) -> DataFrame:
    """Bag union: images and script links become pages and edges like any link.

    pos becomes the place among all targets of the page, kind by kind.
    """
    union = reduce(lambda a, b: a.unionByName(b), parts)
    kinds = F.array(*[F.lit(kind) for kind in KIND_ORDER])
    # Positions inside a kind are below 2^32.
    return union.withColumn("pos", F.array_position(kinds, F.col("kind")) * 2**32 + F.col("pos"))


def admissible(candidates: DataFrame, scope: str = LIMITS.scope, max_length: int = LIMITS.max_url_length) -> DataFrame:
    """Candidates inside the scope with a URL of legal length (FLT-1, FLT-2)."""
    target = F.col("to_url")
    return candidates.where(urls.in_scope(target, scope) & urls.url_length_ok(target, max_length))


class _PageReader(HTMLParser):
    """Text, hrefs, image sources and script bodies of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.hrefs: list[str] = []
        self.sources: list[str] = []
        self.scripts: list[str] = []
        self._inside = ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("script", "style"):
            self._inside = tag
        wanted = {"a": ("href", self.hrefs), "img": ("src", self.sources)}.get(tag)
        if wanted:
            value = next((v for name, v in attrs if name == wanted[0]), None)
            if value is not None:
                wanted[1].append(value)

    def handle_endtag(self, tag: str) -> None:
        if tag == self._inside:
            self._inside = ""

    def handle_data(self, data: str) -> None:
        if self._inside == "script":
            self.scripts.append(data)
        elif not self._inside:
            self.text.append(data)


def _read_page(html: str | None) -> dict:
    reader = _PageReader()
    reader.feed(html or "")
    reader.close()
    text = None if html is None else "".join(reader.text)
    return {"text": text, "hrefs": reader.hrefs, "sources": reader.sources, "scripts": reader.scripts}


_TOKENS = pa.schema(
    [
        ("id", pa.int64()),
        ("text", pa.string()),
        ("hrefs", pa.list_(pa.string())),
        ("sources", pa.list_(pa.string())),
        ("scripts", pa.list_(pa.string())),
    ]
)


def tokenize_pages(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Exact mode: one HTML tokenizer pass over (id, html_content), batch by batch; columns to ``keep`` come along.

    Slower than the expressions in ``functions.markup``; for markup they misread.
    """
    keep = list(keep)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            rows = [{"id": i, **_read_page(h)} for i, h in zip(ids, batch.column("html_content").to_pylist())]
            read = pa.RecordBatch.from_pylist(rows, schema=_TOKENS)
            for name in keep:
                read = read.append_column(name, batch.column(name))
            yield read

    schema = "id bigint, text string, hrefs array<string>, sources array<string>, scripts array<string>"
    kinds = dict(pages.dtypes)
    schema = ", ".join([schema, *[f"`{name}` {kinds[name]}" for name in keep]])
    return pages.select("id", "html_content", *keep).mapInArrow(tokenize, schema)


def page_candidates(pages: DataFrame, fix_www: bool = False) -> DataFrame:
    """Links, images and script links of every page, as ``all_candidates`` gives them; pages has id, url, html_content.

    Markup that the patterns would misread goes through the tokenizer, all other pages stay with the patterns. Either way a
    page is read once, into one row of short arrays.
    """
    html, odd = F.col("html_content"), markup.misread(F.col("html_content"))
    plain = pages.where(~odd).select(
        "id", "url", markup.hrefs(html).alias("hrefs"), markup.image_sources(html).alias("sources"), markup.script_urls(html).alias("scripts")
    )
    exact = tokenize_pages(pages.where(odd), ["url"]).withColumn("scripts", markup.urls_in_scripts(F.col("scripts")))
    read = plain.unionByName(exact.select("id", "url", "hrefs", "sources", "scripts"))

    def placed(kind: str, name: str) -> Column:
        return F.transform(name, lambda value, at: F.struct(F.lit(kind).alias("kind"), at.alias("pos"), value.alias("value")))

    values = F.concat(placed("a", "hrefs"), placed("img", "sources"), placed("script", "scripts"))
    found = read.select("id", urls.origin(F.col("url")).alias("_site"), F.inline(values))
    value, site, kind = F.col("value"), F.col("_site"), F.col("kind")
    target = (
        F.when(kind == "a", urls.canonical_link(value, site, fix_www))
        .when(kind == "img", urls.canonical_image(value, site))
        .otherwise(urls.canonical_link(value, site))
    )
    targets = found.select(F.col("id").alias("from_page"), target.alias("to_url"), "kind", "pos")
    return all_candidates(targets.where(F.col("to_url").isNotNull()))


def sitemap_entries(entries: DataFrame, sites: DataFrame, key: str = "site_id") -> DataFrame:
    """Targets of stored sitemap files: entries (key, pos, loc), and sites (key, from_page, url), one row per key."""
    joined = spread_join(entries, sites.select(key, "from_page", "url"), [key], "inner", ["pos"])
    return joined.select(
        "from_page",
        urls.canonical_link(F.col("loc"), urls.origin(F.col("url"))).alias("to_url"),
        F.lit("sitemap").alias("kind"),
        "pos",
    ).where(F.col("to_url").isNotNull())
