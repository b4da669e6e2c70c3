"""Sitemap files of any size as rows of their entries (EXT-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webgraph_spark.functions import markup
from webgraph_spark.operators.ordering import number_rows
from webgraph_spark.operators.skew import spread_join
from webgraph_spark.session import cut_lineage

_OPEN = "<loc>"


def read_sitemap_files(spark: SparkSession, path: str, key: str = "site_id") -> DataFrame:
    """(key, pos, loc) of every entry below ``path``, whose folders are named ``<key>=<value>``.

    Files are cut at each entry instead of at line ends, so a file on a single line is read by as many tasks as its size asks for,
    and no row holds more than one entry and what follows it. The XML reader takes a file in one task. Entries are
    those that ``markup.sitemap_locations`` finds in the whole text; an entry that the file's end cuts off is none. pos
    numbers the entries of a key by file name and place, from 0.
    """
    pieces = spark.read.option("lineSep", _OPEN).text(path).select(
        F.col(key).cast("long").alias(key),
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # What stands before the first entry of a file begins with a tag; an address never does.
    begins = F.ltrim(F.regexp_replace("value", "^\ufeff", ""))
    entry = ~begins.startswith("<") | begins.startswith("<![CDATA[")
    text = F.when(entry, F.concat(F.lit(_OPEN), F.col("value"))).otherwise(F.col("value"))
    # A piece holds a second entry only where its tag is written differently.
    found = pieces.select(key, "_file", "_block", "_row", F.posexplode(markup.sitemap_locations(text)).alias("_in", "loc"))
    # Row numbers of a scan are settled before the order is sampled.
    numbered = number_rows(cut_lineage(found, "sitemaps"), [key, "_file", "_block", "_row", "_in"], "_n")
    numbered = cut_lineage(numbered.select(key, "_n", "loc"), "sitemap-entries")
    first = numbered.groupBy(key).agg(F.min("_n").alias("_first"))
    return spread_join(numbered, first, [key], "inner", ["_n"]).select(key, (F.col("_n") - F.col("_first")).alias("pos"), "loc")
