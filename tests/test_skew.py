from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows, same
from tidewell.operators import skew


@pytest.fixture(scope="module")
def crowded(spark):
    """20,000 rows: five keys hold 70 %, 1 % have no key, and 500 rows are copies of one row."""
    i = F.col("id")
    key = (
        F.when(i % 100 == 99, None)
        .when(i % 10 < 7, F.concat(F.lit("CORP_"), i % 5))
        .otherwise(F.concat(F.lit("CUST_"), i % 1000))
    )
    made = spark.range(0, 19_500, numPartitions=6).select(i.alias("order_id"), key.alias("customer_id"))
    copies = spark.range(0, 500, numPartitions=6).select(F.lit(-1).cast("long").alias("order_id"), F.lit("CORP_0").alias("customer_id"))
    return made.unionByName(copies)


@pytest.fixture(scope="module")
def customers(spark):
    """Some customers missing, one present twice."""
    return spark.createDataFrame(
        [(f"CORP_{i}", f"n{i}") for i in range(4)] + [("CORP_0", "again")] + [(f"CUST_{i}", f"m{i}") for i in range(0, 900)],
        "customer_id string, name string",
    )


@pytest.mark.parametrize("factor", [1, 7])
def test_salted_join_equals_plain_join(crowded, customers, factor):
    plain = crowded.join(customers, ["customer_id"], "left")
    assert same(skew.salted_join(crowded, customers, "customer_id", factor), plain)
    named = customers.where("customer_id LIKE 'CORP%'").select("customer_id")
    assert same(skew.salted_join(crowded, customers, "customer_id", factor, hot=named), plain)


def test_salting_spreads_the_crowd(spark, crowded, customers):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = skew.salted_join(crowded, customers, "customer_id", 16)
        assert "SortMergeJoin" in plan(spread)
        largest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plain = crowded.repartition(64, "customer_id")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert largest(skew.salted_join(crowded, customers, "customer_id", 64)) < largest(plain) / 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_one_row_get_several_salts(spark):
    copies = spark.range(0, 1000, numPartitions=8).select(F.lit("k").alias("key"), F.lit(1).alias("v"))
    salts = copies.select(F.pmod(F.xxhash64("key", "v", F.spark_partition_id()), F.lit(16)))
    assert salts.distinct().count() > 3


def test_broadcast_is_decided_by_size(crowded, customers):
    plain = crowded.join(customers, ["customer_id"], "left")
    small = skew.broadcast_join(crowded, customers, "customer_id")
    assert "BroadcastHashJoin" in plan(small) and same(small, plain)
    for limits in ({"max_rows": 10}, {"max_bytes": 100}):
        large = skew.broadcast_join(crowded, customers, "customer_id", **limits)
        assert "ResolvedHint (strategy=broadcast)" not in large._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
        assert same(large, plain)


def test_repartitioned_join(crowded, customers):
    joined = skew.repartitioned_join(crowded, customers, "customer_id", 5)
    assert same(joined, crowded.join(customers, ["customer_id"], "left"))


def test_hot_keys_and_diagnosis(spark, crowded):
    assert {r.customer_id for r in skew.hot_keys(crowded, "customer_id").collect()} == {f"CORP_{i}" for i in range(5)}
    row = skew.diagnose(crowded, "customer_id").first()
    assert row.has_skew and row.total_records == 20_000 and row.skew_ratio > 100
    even = skew.diagnose(spark.range(100).select((F.col("id") % 10).alias("k")), "k").first()
    assert (even.max_count, even.median_count, even.skew_ratio, even.has_skew) == (10, 10.0, 1.0, False)
    nothing = skew.diagnose(crowded.where("false"), "customer_id").first()
    assert (nothing.total_records, nothing.unique_keys, nothing.has_skew) == (0, 0, False)


def test_top_keys_break_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in skew.top_keys(df, "k", 2).collect()] == [("c", 2), ("a", 1)]


def test_partition_balance(spark):
    even = skew.partition_balance(spark.range(0, 1000, numPartitions=4)).first()
    assert (even.partitions, even.max_rows, even.balanced) == (4, 250, True)
    lopsided = spark.range(0, 1000, numPartitions=10).where("id < 100 OR id % 100 = 0")
    assert rows(skew.partition_balance(lopsided).select("balanced")) == [(False,)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_grid_join_equals_the_plain_join(spark, how):
    left = spark.createDataFrame([(k, i) for i in range(400) for k in [[1, 1, 2, None, i + 10][i % 5]]], "k int, a int")
    right = spark.createDataFrame([(k, i) for i in range(150) for k in [[1, 2, None, i + 10, 7_000][i % 5]]] + [(1, 3)] * 20, "k int, b int")
    want = left.join(right, ["k"], how)
    for target in (10, 40, 1_000):
        assert same(skew.grid_join(left.repartition(5), right.repartition(4), "k", target, how), want)
    assert same(skew.grid_join(left, right.limit(0), "k", 10, how), left.join(right.limit(0), ["k"], how))


def test_grid_cells_hold_a_bounded_share(spark):
    """One key holds half of both sides; no cell gets more than a small multiple of the target of either side."""
    left = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("a")).repartition(8)
    right = spark.range(2_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("b")).repartition(8)
    assert [tuple(r) for r in skew.join_cells(left, right, "k", 200).collect()] == [(-1, 10, 5)]
    joined = skew.grid_join(left, right, "k", 200)
    assert joined.count() == 2_000 * 1_000 + 2_000
    text = plan(skew.grid_join(left, right, "k", 200))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "_at_rows" in text


@pytest.mark.parametrize("how", ["left", "inner"])
def test_grid_join_aggregates_partners_before_they_meet(spark, how):
    left = spark.createDataFrame([(k, i % 90) for i in range(100) for k in [[1, 1, 2, None, i + 10][i % 5]]], "k int, a int")
    right = spark.createDataFrame([(k, v) for i in range(150) for k, v in [([1, 2, None, i + 10, 7_000][i % 5], None if i % 7 == 0 else i)]] + [(1, 3)] * 20, "k int, b int")
    want = left.join(right, ["k"], how).groupBy("a").agg(F.count("b").alias("n"), F.sum("b").alias("s"))
    for target in (10, 40, 1_000):
        met = skew.grid_join(left.repartition(5), right.repartition(4), "k", target, how, {"n": F.count("b"), "s": F.sum("b")})
        assert same(met.groupBy("a").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("s").alias("s")), want)
    # A row of the left side meets one row per cell of its key, not every row of it.
    cells = skew.join_cells(left, right, "k", 10).where("k = 1").head()
    assert met.where("k = 1").count() == left.where("k = 1").count()
    narrow = skew.grid_join(left, right, "k", 10, how, {"n": F.count("b"), "s": F.sum("b")})
    assert narrow.where("k = 1").count() <= left.where("k = 1").count() * cells["_columns"]


def test_grid_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        skew.grid_join(spark.range(1), spark.range(1), "id", 1, "full")
