"""Rules that keep state over an unbounded run of fetches (STR-1..3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webgraph_spark.functions import shingles
from webgraph_spark.operators import duplicates
from webgraph_spark.schemas import LIMITS
from webgraph_spark.session import cut_lineage, new_path, scratch
from webgraph_spark.streaming import near_index

# Fixed value: the state store that Spark brings for large state.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def fetch_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None, pattern: str | None = None):
    """Parquet files that arrive in ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def stream_first_seen(stream: DataFrame) -> DataFrame:
    """STR-1 over all history: (hash_content, first_id, copies) of pages (id, ord, hash_content).

    A page is a duplicate when it is not the first of its hash. As an aggregate
    each task sends one row per hash, so a hash of a third of all pages costs
    no more than another. Use update mode.
    """
    return duplicates.first_by_hash(stream)


def stream_exact_dedup(stream: DataFrame, event_time: str, delay: str) -> DataFrame:
    """STR-1 with bounded state: pages whose hash was not seen within ``delay``."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["hash_content"])


def stream_site_last_crawled(stream: DataFrame) -> DataFrame:
    """STR-2: last fetch per site; use update mode."""
    return stream.where("site_id is not null").groupBy("site_id").agg(F.max("accessed_time").alias("last_crawled_at"))


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each batch's updated rows under ``path/batch=N``; a batch that runs again replaces its own rows."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def run_updates(stream: DataFrame, name: str) -> DataFrame:
    """Runs a stream over what has arrived and returns its updates with their batch number."""
    spark = stream.sparkSession
    path = new_path(spark, name)
    query = write_updates(stream, path, new_path(spark, f"{name}-state"))
    query.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(path)


def stream_near_dup(
    stream: DataFrame,
    store: str,
    checkpoint: str,
    threshold: float = LIMITS.max_similarity,
    k: int = LIMITS.shingle_words,
    rule: str = "overlap",
) -> StreamingQuery:
    """STR-3: marks texts (id, ord, text) batch by batch against all kept before.

    Marks go to ``store/marks``, what later batches need to the index of ``near_index``, both by batch number, so a
    batch that runs again replaces its own rows. Batches must arrive in order of ord.
    """

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch():
            texts = batch.select("id", "ord", "text", shingles.content_hash(F.col("text")).alias("hash_content"))
            read = cut_lineage(shingles.with_sets(texts, "text", k), "batch")
            known = near_index.stored(spark, store, "hashes", number, read)
            before = duplicates.stored_duplicates(read, known).select("id")
            exact = cut_lineage(before.union(duplicates.exact_duplicates(read).select("id")).distinct(), "exact")
            first = cut_lineage(read.join(exact, "id", "left_anti"), "first")
            kept_before = cut_lineage(near_index.counting(spark, store, number, first, threshold), "counting")
            near = duplicates.near_duplicates(first, threshold, rule, stored=kept_before)
            found = near.select("id", F.lit("near").alias("status")).union(exact.select("id", F.lit("exact").alias("status")))
            marks = read.select("id").join(found, "id", "left").select("id", F.coalesce("status", F.lit("kept")).alias("status"))
            marks.write.mode("overwrite").parquet(f"{store}/marks/batch={number}")
            marked = spark.read.schema("id bigint, status string").parquet(f"{store}/marks/batch={number}")
            kept = cut_lineage(read.join(marked.where("status = 'kept'").select("id"), "id"), "kept")
            near_index.store_batch(store, number, kept, read)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def durable_state(spark: SparkSession) -> None:
    """Keeps stream state on disk (RocksDB) with its changes in the checkpoint, so it may outgrow memory and outlives a restart."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def run_rows(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends what a stream gives for all that has arrived to ``path``, each row once, also over restarts."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
