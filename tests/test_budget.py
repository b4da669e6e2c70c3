import random

import pytest

from tests.brute import admitted
from webgraph_spark.operators import budget


def test_hand_worked(spark):
    items = spark.createDataFrame(list(enumerate([60, 50, 30, 10, 9])), "id bigint, data_size bigint")
    found = budget.byte_budget(items, ["id"], 100).orderBy("id").collect()
    assert [r.admitted for r in found] == [True, False, True, False, True]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_sequential_admission(spark, many_ranges, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 2, 5, 30, 200, 700]) + rng.randint(0, 3) for _ in range(400)]
    limit = rng.choice([100, 997, 5000])
    items = spark.createDataFrame(list(enumerate(sizes)), "id bigint, data_size bigint")
    found = budget.byte_budget(items, ["id"], limit).orderBy("id").collect()
    assert [r.admitted for r in found] == admitted(sizes, limit)


def test_empty_table_holds_nothing(spark):
    assert budget.stored_bytes(spark.createDataFrame([], "data_size bigint")).first()[0] == 0


def test_ranges_are_passed_by_their_sums(spark, many_ranges, monkeypatch):
    opened = []
    plain = budget._opened
    monkeypatch.setattr(budget, "_opened", lambda ranged, order, lefts: opened.append(lefts) or plain(ranged, order, lefts))
    rng = random.Random(8)
    sizes = [rng.randint(1, 100) for _ in range(4000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "id bigint, data_size bigint")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        found = budget.byte_budget(items, ["id"], 150_000)
        assert [r.admitted for r in found.orderBy("id").collect()] == admitted(sizes, 150_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(opened[-1]) <= 26  # of 64; the budget has 18 binary digits


def test_budget_edges(spark):
    items = spark.createDataFrame([(1, 5), (2, None), (3, 0)], "id bigint, data_size bigint")
    known = items.where("data_size is not null")
    assert budget.byte_budget(known, ["id"], 0).where("admitted").count() == 0
    assert {r.id for r in budget.byte_budget(known, ["id"], 5).where("admitted").collect()} == {3}
    assert {r.id for r in budget.byte_budget(known, ["id"], 1).where("admitted").collect()} == {3}
    assert {r.id for r in budget.byte_budget(known, ["id"], 10, stored=3).where("admitted").collect()} == {1, 3}
    assert budget.byte_budget(items.limit(0), ["id"], 10).count() == 0
