import pytest
from pyspark.sql import functions as F

from webgraph_spark.operators import ordering, skew


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    spread_form = {"hot_rows": 100, "lookup_bytes": 0}
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50)
    big = spark.range(3000).withColumn("key", key)
    lookup = spark.range(0, 60, 2).select(F.col("id").cast("int").alias("key"), F.lit("x").alias("value"))
    lookup = lookup.union(spark.createDataFrame([(7, "hot")], lookup.schema)).withColumn("key", F.col("key").cast("bigint"))
    spread = skew.spread_join(big, lookup, ["key"], how, ["id"], **spread_form)
    plain = big.join(lookup, ["key"], how)
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    many_null = spark.range(1000).withColumn("key", F.when(F.col("id") > 700, F.col("id")))
    assert skew.spread_join(many_null, lookup, ["key"], "left", ["id"], **spread_form).count() == 1000
    parts = skew.hot_keys(skew.key_counts(big, ["key"]), ["key"], hot_rows=100).collect()
    assert [(r.key, r._parts) for r in parts if r.key == 7][0][1] > 1


def test_number_rows_is_dense_and_ordered(spark, many_ranges):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("key"))
    numbered = ordering.number_rows(rows, ["key"], "place", first=10).collect()
    assert sorted((r.key, r.place) for r in numbered) == [(i, i + 10) for i in range(5000)]
