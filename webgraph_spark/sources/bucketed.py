"""Stored tables cut into buckets by their key, so that looking up a batch moves only the batch."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from webgraph_spark.session import new_path


def write_bucketed(df: DataFrame, key: Sequence[str], buckets: int, name: str | None = None, path: str | None = None) -> str:
    """Stores ``df`` in ``buckets`` files by a hash of ``key``, each sorted; returns the name of the table."""
    name = name or f"webgraph_{uuid.uuid4().hex}"
    path = path or new_path(df.sparkSession, name)
    rows = df.repartition(buckets, *key)
    rows.write.bucketBy(buckets, *key).sortBy(*key).option("path", path).mode("overwrite").saveAsTable(name)
    return name


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
