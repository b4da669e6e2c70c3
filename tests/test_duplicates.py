import random

import pytest
from pyspark.sql import functions as F

from tests.brute import near_marks
from webgraph_spark.operators import duplicates as D

SIGS = "id bigint, ord bigint, hash array<bigint>, hash_length int"


def _collections(seed, count):
    """Independent small collections: copies, drifting versions, containers, noise."""
    rng = random.Random(seed)
    rows, groups = [], []
    for c in range(count):
        base = c * 10_000
        pool = list(range(base, base + rng.choice([12, 20, 40])))
        group, sets = [], []
        for _ in range(rng.randint(2, 9)):
            kind = rng.random()
            if sets and kind < 0.6:
                own = set(rng.choice(sets))
                for _ in range(rng.randint(0, 3)):
                    if own and rng.random() < 0.5:
                        own.discard(rng.choice(sorted(own)))
                    else:
                        own.add(rng.choice(pool))
                if rng.random() < 0.3:
                    own |= set(rng.sample(pool, rng.randint(1, len(pool) // 2)))
            else:
                own = set(rng.sample(pool, rng.randint(0, len(pool))))
            sets.append(own)
            group.append((len(rows), own))
            rows.append((len(rows), len(rows), sorted(own), len(own)))
        groups.append(group)
    return rows, groups


@pytest.mark.parametrize("threshold,rule", [(0.95, "overlap"), (0.5, "overlap"), (0.3, "max_jaccard")])
def test_near_duplicates_equal_sequential_rule(spark, threshold, rule):
    rows, groups = _collections(int(threshold * 100), 120)
    expected = {}
    for group in groups:
        expected.update(near_marks(group, threshold, rule))
    found = D.near_duplicates(spark.createDataFrame(rows, SIGS), threshold, rule).collect()
    assert {r.id: (r.matched_id, r.similarity) for r in found} == expected
    assert expected


def _sig(page, values):
    values = list(values)
    return (page, page, values, len(values))


def test_candidate_is_overlap_not_similarity(spark):
    sigs = spark.createDataFrame(
        [_sig(1, range(1, 1001)), _sig(2, range(1, 50)), _sig(3, range(1, 51))], SIGS
    )
    assert D.near_duplicates(sigs).count() == 0
    assert [tuple(r) for r in D.near_duplicates(sigs, rule="max_jaccard").collect()] == [(3, 2, 49 / 50)]


def test_threshold_is_strict(spark):
    sigs = spark.createDataFrame([_sig(1, range(1, 101)), _sig(2, range(1, 96)), _sig(3, [])], SIGS)
    assert D.near_duplicates(sigs).count() == 0
    assert D.near_duplicates(sigs, 0.94).count() == 1


@pytest.mark.parametrize("k,threshold,near", [(10, 0.5, 27), (3, 0.5, 61)])
def test_document_counts(spark, k, threshold, near):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pages = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), F.col("text").alias("html_content"))
    marks = D.mark_duplicates(pages, threshold, k, text=F.col("html_content"))
    counts = {r.status: r["count"] for r in marks.groupBy("status").count().collect()}
    assert counts == {"exact": 73, "near": near, "kept": 927 - near}


def test_unknown_order_comes_first_and_is_marked(spark):
    rows = [(1, 5, [1, 2, 3], 3), (2, None, [1, 2, 3], 3), (3, 6, [7, 8, 9], 3)]
    found = D.near_duplicates(spark.createDataFrame(rows, SIGS), 0.5).collect()
    assert [(r.id, r.matched_id) for r in found] == [(1, 2)]


def test_one_kept_page_settles_a_large_group_of_copies(spark, monkeypatch):
    """Every copy differs a little from every other; only the first is met by the rest."""
    monkeypatch.setattr(D, "ROWS_PER_PART", 50)
    sizes = []
    meet = D._meet
    monkeypatch.setattr(D, "_meet", lambda *a: sizes.append(meet(*a)) or sizes[-1])
    rows = [_sig(i, [*range(1, 201), 1000 + i]) for i in range(400)]
    found = D.near_duplicates(spark.createDataFrame(rows, SIGS)).collect()
    assert sorted((r.id, r.matched_id) for r in found) == [(i, 0) for i in range(1, 400)]
    assert max(s.count() for s in sizes) < 1000


def test_chains_of_open_pages_end_without_a_round_each(spark, monkeypatch):
    """Each page is similar to the one before only, so every other one is kept."""
    calls = []
    decide = D._decide
    monkeypatch.setattr(D, "_decide", lambda *a: calls.append(1) or decide(*a))
    rows = [_sig(i, range(10 * i, 10 * i + 30)) for i in range(12)]
    found = D.near_duplicates(spark.createDataFrame(rows, SIGS), 0.4).collect()
    assert sorted((r.id, r.matched_id) for r in found) == [(i, i - 1) for i in range(1, 12, 2)]
    assert not calls


def test_longer_page_without_small_common_shingles_is_a_rival(spark):
    """Page 1 holds all of page 3, but shares none of its smallest shingles; at 0.95 it is not ranked."""
    rows = [_sig(1, [*range(1000), *range(10_000, 10_100)]), _sig(2, range(10_000, 10_099)), _sig(3, range(10_000, 10_100))]
    sigs = spark.createDataFrame(rows, SIGS)
    assert D.near_duplicates(sigs).count() == 0
    assert [tuple(r) for r in D.near_duplicates(sigs, rule="max_jaccard").collect()] == [(3, 2, 0.99)]
