"""Seed lists (SRC-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webgraph_spark.functions import urls
from webgraph_spark.schemas import LIMITS


def seed_urls(lines: DataFrame, max_length: int = LIMITS.max_url_length) -> DataFrame:
    """Distinct URLs of lines (value); a line with ``#`` anywhere is skipped.

    Seeds stay as written: neither canonical nor checked for scope.
    """
    url = F.trim(F.col("value"), F.lit(" \t\n\r\x0b\x0c")).alias("url")
    kept = lines.where(~F.col("value").contains("#")).select(url)
    return kept.where(urls.url_length_ok(F.col("url"), max_length)).distinct()


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return seed_urls(spark.read.text(path))
