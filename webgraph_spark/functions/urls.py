"""URL rules as Column expressions (URL-1..7, FLT-1, FLT-2, FLT-4, FLT-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webgraph_spark.schemas import LIMITS

# Characters a canonical link keeps unescaped besides letters,
# digits and "_.-~", with the escape Spark's url_encode writes for each.
LINK_SAFE = {":": "%3A", "/": "%2F", "&": "%26", "?": "%3F", "+": "%2B", "=": "%3D"}
PATH_SAFE = {"/": "%2F"}

# Fragments of an href that mark an action instead of a page.
ACTION_MARKS = ["javascript:", "mailto:", "tel:"]

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_ORIGIN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"


def origin(url: Column) -> Column:
    """``scheme://netloc/``; port, user info and host case are kept."""
    scheme = F.lower(F.regexp_extract(url, _SCHEME, 1))
    return F.concat(scheme, F.lit("://"), F.regexp_extract(url, _NETLOC, 1), F.lit("/"))


def in_scope(url: Column, suffix: str = LIMITS.scope) -> Column:
    """Substring test of ``suffix`` in the origin, so ``http://gov.si/`` fails."""
    return origin(url).contains(suffix)


def url_length_ok(url: Column, limit: int = LIMITS.max_url_length) -> Column:
    return F.char_length(url) <= limit


def percent_encode(text: Column, safe: dict[str, str] = LINK_SAFE) -> Column:
    """Percent-encode UTF-8 bytes; ``%`` itself is encoded, so ``%20`` -> ``%2520``."""
    # url_encode writes form encoding: blank as "+", "~" escaped, "*" kept.
    encoded = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    encoded = F.replace(encoded, F.lit("*"), F.lit("%2A"))
    encoded = F.replace(encoded, F.lit("%7E"), F.lit("~"))
    for char, escape in safe.items():
        encoded = F.replace(encoded, F.lit(escape), F.lit(char))
    return encoded


def percent_decode(text: Column) -> Column:
    """Decode ``%XX``; ``+`` and broken escapes stay as they are."""
    guarded = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))


def is_page_link(href: Column) -> Column:
    """FLT-4: False for empty hrefs, actions, anchors and the index page."""
    action = F.lit(False)
    for mark in ACTION_MARKS:
        action = action | href.contains(mark)
    relative_ok = ~action & ~href.startswith("#") & (href != "/")
    return F.coalesce((href != "") & (href.startswith("http") | relative_ok), F.lit(False))


def is_image_source(src: Column) -> Column:
    """FLT-5: False for empty sources and inline image data."""
    return F.coalesce((src != "") & ~src.startswith("data:image"), F.lit(False))


def _join_origin(ref: Column, site: Column) -> Column:
    path = F.when(ref.startswith("/") & site.endswith("/"), F.substring(ref, 2, 2**31 - 1)).otherwise(
        F.when(~ref.startswith("/") & ~site.endswith("/"), F.concat(F.lit("/"), ref)).otherwise(ref)
    )
    return F.trim(F.concat(site, path), F.lit(" \t\n\r\x0b\x0c"))


def canonical_link(href: Column, site: Column, fix_www: bool = False) -> Column:
    """Absolute, fragment-free, percent-encoded form of an href, NULL if it is no page link.

    ``fix_www`` makes ``www.x`` absolute instead of putting the site before it.
    """
    www = F.concat(F.lit("http://"), href)
    if fix_www:
        joined = F.when(href.startswith("www"), F.trim(www)).otherwise(_join_origin(href, site))
    else:
        joined = _join_origin(F.when(href.startswith("www"), F.trim(www)).otherwise(href), site)
    absolute = F.when(href.startswith("http"), href).otherwise(joined)
    return F.when(is_page_link(href), percent_encode(F.substring_index(absolute, "#", 1)))


def canonical_image(src: Column, site: Column) -> Column:
    """Absolute image URL; fragment and characters stay as they are."""
    absolute = F.when(src.startswith("http"), src).otherwise(_join_origin(src, site))
    return F.when(is_image_source(src), absolute)


def image_filename(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def drop_empty_parts(url: Column) -> Column:
    """Remove a trailing ``#``, an empty query and empty parameters."""
    out = F.regexp_replace(url, r"#$", "")
    out = F.regexp_replace(out, r"^([^?#]*)\?(?=#|$)", "$1")
    return F.regexp_replace(out, r"^([^?#]*/[^/;?#]*|[^/;?#]*);(?=[?#]|$)", "$1")


def robots_path(url: Column) -> Column:
    """The part of a URL that robots rules are matched with; never empty."""
    rest = F.regexp_replace(percent_decode(url), _ORIGIN, "")
    path = percent_encode(drop_empty_parts(rest), PATH_SAFE)
    return F.when(path == "", F.lit("/")).otherwise(path)
