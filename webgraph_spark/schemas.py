"""Table schemas, code tables and default limits of the crawl data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Page type codes.
PAGE_TYPES = ["HTML", "BINARY", "IMAGE", "DUPLICATE", "FRONTIER", "DISALLOWED", "ERROR"]

# Data type codes of stored binaries.
DATA_TYPES = ["PDF", "DOC", "DOCX", "PPT", "PPTX"]

# MIME type -> code, matched by equality (CLS-2).
MIME_CODES = {
    "text/html": "HTML",
    "application/pdf": "PDF",
    "application/msword": "DOC",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "DOCX",
    "application/vnd.ms-powerpoint": "PPT",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "PPTX",
    "a": "A",
    "image": "IMG",
}

# Report legend, page type -> colour; other types use the default.
TYPE_COLOURS = {"DISALLOWED": "grey", "ERROR": "red", "DUPLICATE": "yellow"}
DEFAULT_COLOUR = "default"

# Column widths checked by INT-3, (table, column) -> characters.
COLUMN_WIDTHS = {
    ("data_type", "code"): 20,
    ("page_type", "code"): 20,
    ("site", "domain"): 500,
    ("page", "page_type_code"): 20,
    ("page", "url"): 3000,
    ("page_data", "data_type_code"): 20,
    ("image", "filename"): 255,
    ("image", "content_type"): 50,
}


@dataclass(frozen=True)
class Limits:
    """The limits a crawl runs with by default."""

    scope: str = ".gov.si"
    max_url_length: int = 2000
    max_page_rows: int | None = None
    max_stored_bytes: int = 1024**3
    shingle_words: int = 10
    max_similarity: float = 0.95
    report_links: int = 1500
    report_pages: int = 3500
    report_domain: str = "http://evem.gov.si/"
    page_size_units: int = 5


LIMITS = Limits()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


SITE = _struct(
    ("id", T.LongType()),
    ("domain", T.StringType()),
    ("robots_content", T.StringType()),
    ("sitemap_content", T.StringType()),
    ("last_crawled_at", T.TimestampNTZType()),
)

PAGE = _struct(
    ("id", T.LongType()),
    ("site_id", T.LongType()),
    ("page_type_code", T.StringType()),
    ("url", T.StringType()),
    ("html_content", T.StringType()),
    ("hash_content", T.StringType()),
    ("http_status_code", T.IntegerType()),
    ("accessed_time", T.TimestampNTZType()),
    ("added_at_time", T.TimestampNTZType()),
    ("active_in_crawler", T.BooleanType()),
)

PAGE_DATA = _struct(
    ("page_id", T.LongType()),
    ("data_type_code", T.StringType()),
    ("data", T.BinaryType()),
    ("data_size", T.LongType()),
)

CONTENT_HASH = _struct(
    ("page_id", T.LongType()),
    ("hash", T.ArrayType(T.LongType())),
    ("hash_length", T.IntegerType()),
)

IMAGE = _struct(
    ("page_id", T.LongType()),
    ("filename", T.StringType()),
    ("content_type", T.StringType()),
    ("data", T.BinaryType()),
    ("data_size", T.LongType()),
    ("accessed_time", T.TimestampNTZType()),
)

LINK = _struct(("from_page", T.LongType()), ("to_page", T.LongType()))

FETCH_LOG = _struct(
    ("page_id", T.LongType()),
    ("url", T.StringType()),
    ("site_id", T.LongType()),
    ("status", T.IntegerType()),
    ("content_type", T.StringType()),
    ("body", T.BinaryType()),
    ("html", T.StringType()),
    ("accessed_time", T.TimestampNTZType()),
    ("error", T.StringType()),
)

TABLES = {
    "site": SITE,
    "page": PAGE,
    "page_data": PAGE_DATA,
    "content_hash": CONTENT_HASH,
    "image": IMAGE,
    "link": LINK,
}
