import datetime as dt
import os

from pyspark.sql import functions as F

from webgraph_spark.operators import duplicates
from webgraph_spark.session import new_path
from webgraph_spark.streaming import fetches, near_index

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_near_duplicates_batch_by_batch_equal_one_batch(spark):
    texts = spark.read.parquet(DOCS).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "text")
    arriving = new_path(spark, "arriving")
    for low, high in ((0, 70), (70, 140), (140, 10**9)):
        texts.where((F.col("id") >= low) & (F.col("id") < high)).coalesce(1).write.mode("append").parquet(arriving)
    stream = fetches.fetch_stream(spark, arriving, texts.schema, files_per_batch=1)
    store = new_path(spark, "store")
    fetches.stream_near_dup(stream, store, new_path(spark, "state"), threshold=0.3, k=3).awaitTermination()
    marks = spark.read.parquet(f"{store}/marks")
    assert marks.select("batch").distinct().count() == 3
    found = {r.id: r.status for r in marks.collect()}
    whole = duplicates.mark_duplicates(texts.withColumnRenamed("text", "html_content"), 0.3, 3, text=F.col("html_content"))
    expected = {r.id: r.status for r in whole.collect()}
    assert found == expected and set(expected.values()) == {"kept", "exact", "near"}


def test_first_seen_and_last_crawled_over_batches(spark):
    arriving = new_path(spark, "arriving")
    t0 = dt.datetime(2024, 1, 1)
    for part in range(3):
        rows = [(part * 10 + i, f"h{i % 4}", i % 2, t0 + dt.timedelta(minutes=part * 10 + i)) for i in range(10)]
        frame = spark.createDataFrame(rows, "id bigint, hash_content string, site_id bigint, accessed_time timestamp_ntz")
        frame.coalesce(1).write.mode("append").parquet(arriving)
    stream = fetches.fetch_stream(spark, arriving, frame.schema, files_per_batch=1)
    pages = stream.withColumn("ord", F.col("id"))
    updates = fetches.run_updates(fetches.stream_first_seen(pages), "first").orderBy("batch").collect()
    latest = {r.hash_content: (r.first_id, r.copies) for r in updates}
    assert latest == {"h0": (0, 9), "h1": (1, 9), "h2": (2, 6), "h3": (3, 6)}
    last = fetches.run_updates(fetches.stream_site_last_crawled(stream), "last").groupBy("site_id").agg(F.max("last_crawled_at"))
    assert {r[0]: r[1].minute for r in last.collect()} == {0: 28, 1: 29}


def test_dedup_within_watermark(spark):
    arriving = new_path(spark, "arriving")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, f"h{i % 3}", t0 + dt.timedelta(seconds=i)) for i in range(12)]
    frame = spark.createDataFrame(rows, "id bigint, hash_content string, at timestamp")
    frame.coalesce(1).write.parquet(arriving)
    stream = fetches.stream_exact_dedup(fetches.fetch_stream(spark, arriving, frame.schema), "at", "1 hour")
    path = new_path(spark, "unique")
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", new_path(spark, "state"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.hash_content for r in spark.read.parquet(path).collect()) == ["h0", "h1", "h2"]


def test_a_batch_reads_only_its_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_index, "BUCKETS", 64)
    store = new_path(spark, "store")
    for number in range(4):
        ids = range(number * 40, number * 40 + 40)
        words = [[f"w{i * 7 % 997}x{j}" for j in range(30)] for i in ids]
        texts = spark.createDataFrame([(i, i, " ".join(w)) for i, w in zip(ids, words)], "id bigint, ord bigint, text string")
        sigs = duplicates.text_signatures(texts, 3)
        near_index.store_batch(store, number, sigs, texts.withColumn("hash_content", F.sha2("text", 256)))
    new = spark.createDataFrame([(999, 999, " ".join(f"w{50 * 7 % 997}x{j}" for j in range(29)))], "id bigint, ord bigint, text string")
    own = duplicates.text_signatures(new, 3)
    asked = near_index.probes(own, near_index.stored(spark, store, "frequent", 4), 0.9).select("shingle").distinct()
    assert asked.count() == 27 - 25 + 1
    rows = near_index.stored(spark, store, "postings", 4, asked)
    files = [r[0] for r in rows.select(F.input_file_name()).distinct().collect()]
    wanted = {r[0] for r in asked.select(near_index.bucket("shingle")).collect()}
    assert files and {int(f.split("bucket=")[1].split("/")[0]) for f in files} <= wanted and len(wanted) <= 3
    assert {r.id for r in near_index.counting(spark, store, 4, own, 0.9).collect()} == {50}
    # A batch that runs again does not see itself.
    assert {r.id for r in near_index.counting(spark, store, 1, own, 0.9).collect()} == set()


def test_state_outlives_a_restart_and_is_evicted(spark):
    fetches.durable_state(spark)
    arriving, path, state = (new_path(spark, name) for name in ("arriving", "unique", "state"))
    t0 = dt.datetime(2024, 1, 1)
    # The second a is within the delay; c moves the watermark on, so the last a and b come after what was known of them is gone.
    for hours in ([("a", 0)], [("a", 1), ("b", 1)], [("c", 40)], [("a", 50), ("b", 50)]):
        rows = [(name, t0 + dt.timedelta(hours=h)) for name, h in hours]
        frame = spark.createDataFrame(rows, "hash_content string, at timestamp")
        frame.coalesce(1).write.mode("append").parquet(arriving)
        stream = fetches.stream_exact_dedup(fetches.fetch_stream(spark, arriving, frame.schema), "at", "3 hours")
        fetches.run_rows(stream, path, state)  # a new query each time, from the same checkpoint
    found = sorted((r.hash_content, (r.at - t0).total_seconds() / 3600) for r in spark.read.parquet(path).collect())
    assert found == [("a", 0), ("a", 50), ("b", 1), ("b", 50), ("c", 40)]


def test_batches_leave_no_work_tables(spark):
    texts = spark.createDataFrame([(i, i, f"text number {i % 3} of many") for i in range(9)], "id bigint, ord bigint, text string")
    arriving, store = new_path(spark, "arriving"), new_path(spark, "store")
    texts.write.parquet(arriving)
    base = os.path.dirname(store)
    fetches.stream_near_dup(fetches.fetch_stream(spark, arriving, texts.schema), store, new_path(spark, "state"), k=2).awaitTermination()
    before = set(os.listdir(base))
    texts.withColumn("id", F.col("id") + 100).write.mode("append").parquet(arriving)
    fetches.stream_near_dup(fetches.fetch_stream(spark, arriving, texts.schema), store, new_path(spark, "state"), k=2).awaitTermination()
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(base)) - before} <= {"state"}
