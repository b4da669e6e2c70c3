import os
import random

import numpy as np
from pyspark.sql import functions as F

from webgraph_spark.functions import shingles
from webgraph_spark.operators import duplicates as D
from webgraph_spark.operators import ranking
from webgraph_spark.session import new_path
from webgraph_spark.streaming import near_index

SIGS = "id bigint, ord bigint, hash array<bigint>, hash_length int"


def test_sets_cut_in_batches_equal_those_of_expressions(spark):
    blanks = "".join(chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
    texts = [blanks.join("abcabcd"), "a b", "", blanks, None, "ä​b ﻿ c d e", "é ü é ü é ü é"]
    rows = spark.createDataFrame([*enumerate(texts)], "id int, text string")
    odd = [bytearray(b"a \xff b c d"), bytearray(b"\xed\xa0\x80 b c d"), bytearray(b"\xe2\x82 x y z")]
    broken = spark.createDataFrame([(100 + i, b) for i, b in enumerate(odd)], "id int, b binary")
    rows = rows.unionByName(broken.select("id", F.col("b").cast("string").alias("text")))
    expected = {r.id: r.hash for r in rows.select("id", shingles.shingle_set(F.col("text"), 2).alias("hash")).collect()}
    found = shingles.with_sets(rows, "text", 2).collect()
    assert {r.id: r.hash for r in found} == expected
    assert all(r.hash_length == len(r.hash) for r in found) and sum(r.hash_length for r in found) > 15
    as_bytes = shingles.with_sets(rows, "text", 2, as_bytes=True).collect()
    assert {r.id: shingles.unpacked(bytes(r.hash)).tolist() for r in as_bytes} == expected


def test_numbers_beyond_crc32_are_packed_whole():
    for values in ([], [0, 2**32 - 1], [-1, 5], [2**32], [-(2**63), 2**63 - 1]):
        assert shingles.unpacked(shingles.packed(np.array(values, np.int64))).tolist() == values


def test_frequencies_come_back_over_slices_and_parts(spark, monkeypatch):
    """Pages of many slices and parts, one of them with more shingles than a slice takes."""
    monkeypatch.setattr(ranking, "SLICE_TOKENS", 60)
    monkeypatch.setattr(ranking, "CORE_TOKENS", 100)
    rng = random.Random(4)
    pages = [(i, None if i % 7 == 0 else -i, rng.sample(range(-40, 400), rng.randint(1, 30)), i % 3 == 0) for i in range(90)]
    pages += [(90, 90, [*range(200)], False), (91, 91, [2**40, 7], True), (92, 92, [2**40, -(2**50)], False), (93, 93, [10**9], False)]
    rows = [(i, o, h, len(h), known) for i, o, h, known in pages]
    sigs = shingles.with_packed(spark.createDataFrame(rows, f"{SIGS}, known boolean").repartition(3))
    times = {}
    for _, _, own, _ in pages:
        for value in own:
            times[value] = times.get(value, 0) + 1
    expected = {}
    for i, o, own, known in pages:
        shared = sorted((times[v], v) for v in own if times[v] > 1)
        if shared:
            expected[i] = (o, len(own), known, shared)
    found = D.rank_shingles(sigs, "known").collect()
    assert {r.id: (r.ord, r.n, r.known, [(s.df, s.shingle) for s in r.shared]) for r in found} == expected
    assert len(found) == len(expected) < len(pages)


def test_one_shingle_stands_for_all_that_the_same_pages_hold(spark):
    """Two copies share 300 rare shingles but meet by one, a third page by one more."""
    lists = {page: [(token, 2) for token in range(300)] for page in (1, 2)}
    lists[3] = [(5000, 2), (6000, 1)]
    lists[2].append((5000, 2))
    rows = [(page, page, 600, df, token, False) for page, tokens in lists.items() for token, df in tokens]
    rare = spark.createDataFrame(rows, "id bigint, ord bigint, n int, df bigint, token bigint, known boolean")
    found = D._one_of_each_list(rare).collect()
    assert sorted((r.id, r.token) for r in found) == [(1, 0), (2, 0), (2, 5000), (3, 5000)]


def test_pages_that_come_twice_are_put_together(spark):
    once = [(1, 1, [1, 2, 3, 4], 4), (2, 2, [1, 2, 3, 5], 4), (3, 3, [8, 9], 2)]
    found = D.near_duplicates(spark.createDataFrame(once + once, SIGS), 0.5).collect()
    assert [tuple(r) for r in found] == [(2, 1, 0.6)]


def test_an_index_makes_folders_for_postings_only(spark):
    store = new_path(spark, "store")
    texts = spark.createDataFrame([(i, i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(80)], "id bigint, ord bigint, text string")
    sigs = D.text_signatures(texts, 3)
    near_index.store_batch(store, 0, sigs, texts.withColumn("hash_content", F.sha2("text", 256)))
    folders = {name: [f for f in os.listdir(f"{store}/{name}/batch=0") if f.startswith("bucket=")] for name in near_index.SCHEMAS}
    assert [name for name, own in folders.items() if own] == ["postings"]
    assert near_index.stored(spark, store, "hashes", 1, texts.limit(3).withColumn("hash_content", F.sha2("text", 256))).count() >= 3
    met = near_index.stored(spark, store, "signatures", 1, spark.createDataFrame([(7,), (50,)], "id bigint"))
    assert {7, 50} <= {r.id for r in met.collect()} and met.count() < 80


def test_frequent_shingles_come_last_among_probes(spark):
    """Shingles on many pages are found over batches and parts, and a probe asks for others first."""
    rows = [(i, i, [1, 2, *range(100 * i, 100 * i + 8)], 10) for i in range(1, 71)]
    sigs = spark.createDataFrame(rows, SIGS).repartition(5)
    frequent = ranking.shingles_on(sigs, 64)
    assert sorted(r.shingle for r in frequent.collect()) == [1, 2]
    asked = near_index.probes(sigs, frequent, 0.35).collect()
    assert len(asked) == 70 * (10 - 4 + 1) and not {r.shingle for r in asked} & {1, 2}
