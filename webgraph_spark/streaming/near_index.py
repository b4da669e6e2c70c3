"""What a stream of texts has kept, stored so that a batch reads only what it may meet (STR-3).

Kept texts are stored three times, each time in buckets below a folder per batch: by content hash, by shingle
(an inverted index: shingle, id) and by id (the signatures). A batch asks the buckets its own hashes fall into, then those of
a few of its shingles, then those of the ids found there.

Few shingles are enough. A stored text counts for a text of n shingles only if the two share more than t * n of them:
otherwise it is not similar, nor can it have more in common than a similar one. It then holds one of any
n - ceil(t * n) + 1 shingles of the text. Which ones is free, so the ones that many stored texts hold come last
(``FREQUENT`` texts of one batch), the others in order of a hash.

A batch that runs again replaces its own folders and never reads them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgraph_spark.functions import shingles
from webgraph_spark.operators import ranking
from webgraph_spark.session import cut_lineage

BUCKETS = 256
FREQUENT = 64
# Bits of the filter of frequent shingles, of which at most FILTERS are put together; a shingle that is taken for frequent
# only comes later in the order.
BITS = 2**23
FILTERS = 8
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

SCHEMAS = {
    "hashes": "id bigint, ord bigint, hash_content string",
    "postings": "shingle bigint, id bigint",
    "signatures": "id bigint, ord bigint, hash array<bigint>, hash_length int",
    "frequent": "shingle bigint",
}
# Tables with a folder for each bucket. A folder costs more than most buckets of the narrower ones hold, so these are sorted
# by bucket, and a reader skips the files and pages of other buckets.
FOLDERS = {"postings"}
KEYS = {"hashes": "hash_content", "postings": "shingle", "signatures": "id", "frequent": "shingle"}


def bucket(key: str | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def store_batch(store: str, number: int, kept: DataFrame, seen: DataFrame) -> None:
    """Adds the signatures ``kept`` (id, ord, hash, hash_length) and all hashes ``seen`` (id, ord, hash_content)."""
    postings = kept.select(F.explode("hash").alias("shingle"), "id")
    frequent = ranking.shingles_on(kept, FREQUENT)
    spark = kept.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = {"hashes": seen, "postings": postings, "signatures": kept, "frequent": frequent}
    for name, rows in parts.items():
        columns = [part.split()[0] for part in SCHEMAS[name].split(", ")]
        cut = rows.select(*columns, bucket(KEYS[name]).alias("bucket"))
        if name in FOLDERS:
            # With a number, so that a small batch's folders are not all made by one task.
            writer = cut.repartition(min(BUCKETS, tasks), "bucket").write.partitionBy("bucket")
        else:
            writer = cut.repartitionByRange("bucket").sortWithinPartitions("bucket").write
        writer.mode("overwrite").parquet(f"{store}/{name}/batch={number}")


def stored(spark: SparkSession, store: str, name: str, number: int, keys: DataFrame | None = None) -> DataFrame:
    """Rows of batches before ``number``; with ``keys`` those in their buckets, at most ``BUCKETS`` numbers on the driver."""
    if number == 0:
        return spark.createDataFrame([], SCHEMAS[name])
    reader = spark.read.schema(f"{SCHEMAS[name]}, batch bigint, bucket int").option("basePath", f"{store}/{name}")
    rows = reader.parquet(f"{store}/{name}").where(F.col("batch") < number)
    if keys is not None:
        wanted = [row[0] for row in keys.select(bucket(KEYS[name])).distinct().collect()]
        rows = rows.where(F.col("bucket").isin(wanted)) if wanted else rows.limit(0)
    return rows.drop("batch", "bucket")


def _mixed(values: np.ndarray) -> np.ndarray:
    return values.view(np.uint64) * _SPREAD


def _bits_of(values: np.ndarray) -> np.ndarray:
    return (_mixed(values) >> np.uint64(32)) % np.uint64(BITS)


def _often(frequent: DataFrame) -> bytes:
    """A filter of the shingles ``frequent``; its size is fixed."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for batch in batches:
            bits[_bits_of(batch.column(0).to_numpy().astype(np.int64))] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    found = frequent.select("shingle").coalesce(FILTERS).mapInArrow(fill, "bits binary").collect()
    return reduce(np.bitwise_or, [np.frombuffer(row[0], np.uint8) for row in found], np.zeros(BITS // 8, np.uint8)).tobytes()


def probes(texts: DataFrame, frequent: DataFrame, threshold: float) -> DataFrame:
    """(id, shingle): the shingles of which a stored text that counts holds one."""
    slack = 1e-9
    often = texts.sparkSession.sparkContext.broadcast(_often(frequent))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(often.value, np.uint8)).view(bool)
        for batch in batches:
            chosen = []
            for own, n in zip(batch.column("hash"), batch.column("hash_length").to_pylist()):
                values = own.values.to_numpy().astype(np.int64)
                count = max(1, n - int(np.ceil(n * threshold - n * slack - slack)) + 1)
                order = np.lexsort((_mixed(values), bits[_bits_of(values)]))
                chosen.append(values[order[:count]])
            lists = shingles.lists(chosen)
            ids = batch.column("id").take(pc.list_parent_indices(lists))
            yield pa.RecordBatch.from_arrays([ids, lists.flatten()], ["id", "shingle"])

    narrow = texts.select("id", "hash", "hash_length")
    return narrow.mapInArrow(first, f"{shingles.columns_of(narrow, ['id'])}, shingle long")


def counting(spark: SparkSession, store: str, number: int, texts: DataFrame, threshold: float) -> DataFrame:
    """The stored signatures that can count for one of ``texts`` (id, ord, hash, hash_length)."""
    if number == 0:
        return stored(spark, store, "signatures", number)
    own = texts.where("hash_length > 0")
    frequent = stored(spark, store, "frequent", number, own.select(F.explode("hash").alias("shingle")))
    # Written, as the buckets to read are found from them before they are looked up.
    asked = cut_lineage(probes(own, frequent, threshold).select("shingle").distinct(), "asked")
    met = stored(spark, store, "postings", number, asked).join(asked, "shingle", "left_semi").select("id").distinct()
    met = cut_lineage(met, "met")
    return stored(spark, store, "signatures", number, met).join(met, "id", "left_semi")
