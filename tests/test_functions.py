from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell import session
from tidewell.functions import labels, numbers, text


def _half_up(value: Decimal, places: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**11), 10**11), st.integers(1, 10**7)), min_size=1, max_size=50))
def test_ratios_round_half_up_exactly(spark, pairs):
    df = spark.createDataFrame([(Decimal(c) / 100, n) for c, n in pairs], "amount decimal(18,2), n long")
    found = df.select(
        "amount",
        "n",
        numbers.ratio(F.col("amount"), F.col("n"), 3).alias("r"),
        numbers.mean_money(F.col("amount"), F.col("n")).alias("m"),
    ).collect()
    for row in found:
        assert row.r == _half_up(row.amount / row.n, 3)
        assert float(row.m) == _half_up(row.amount / row.n, 2)


def test_ratios_of_doubles_and_large_values(spark):
    cases = [(0.125, 1.0, 3, 0.125), (0.29, 1.0, 2, 0.29), (9e15, 1.0, 6, 9e15), (1e16, 7.0, 2, 1428571428571428.57), (-1.0, 3.0, 2, -0.33)]
    cases += [(0.005, 1.0, 2, 0.01), (-0.005, 1.0, 2, -0.01), (1.0, 0.0, 2, None), (1e30, 7.0, 2, None), (None, 1.0, 2, None)]
    for top, bottom, places, want in cases:
        df = spark.createDataFrame([(top, bottom)], "a double, b double")
        found = df.select(numbers.ratio(F.col("a"), F.col("b"), places), numbers.mean_money(F.col("a"), F.col("b"))).head()
        assert found[0] == (pytest.approx(want, rel=1e-15) if want is not None else None)
        if want is not None and places == 2:
            assert float(found[1]) == pytest.approx(want, rel=1e-15)
    too_large = spark.createDataFrame([(1e17, 1.0)], "a double, b double").select(numbers.mean_money(F.col("a"), F.col("b"))).head()[0]
    assert too_large is None


def test_percent_of_nothing_is_unknown(spark):
    df = spark.createDataFrame([(1, 8), (1, 0), (None, 5), (3, None)], "a long, b long")
    found = [r[0] for r in df.select(numbers.percent(F.col("a"), F.col("b"))).collect()]
    assert found == [12.5, None, None, None]


def test_money_rejects_text_that_is_no_number(spark):
    df = spark.createDataFrame([("1.005",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(numbers.money(F.col("v"))).collect()] == [Decimal("1.01"), None, None]


def test_tiers_are_inclusive_unless_strict(spark):
    values = [499, 500, 200, 50, 49, None, 14, 15, 30, 31]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = df.select(labels.segment(F.col("v")), labels.recency_risk(F.col("v"))).collect()
    assert [r[0] for r in found] == [
        "Regular", "Premium", "Regular", "Occasional", "New", "New", "New", "New", "New", "New",
    ]
    assert [r[1] for r in found][-4:] == ["Low", "Medium", "Medium", "High"]


def test_score_risks(spark):
    df = spark.createDataFrame([(0.7,), (0.6999,), (0.4,), (0.1,), (None,)], "v double")
    assert [r[0] for r in df.select(labels.score_risk(F.col("v"))).collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_payment_categories_and_operations(spark):
    df = spark.createDataFrame([(" Credit_Card",), ("paypal",), ("bank_transfer",), ("cash",), (None,)], "v string")
    found = [r[0] for r in df.select(labels.payment_category(F.col("v"))).collect()]
    assert found == ["card", "digital_wallet", "bank", "other", "other"]
    ops = spark.createDataFrame([("insert",), ("U",), ("DELETE ",), ("x",), (None,)], "v string")
    assert [r[0] for r in ops.select(labels.operation_code(F.col("v"))).collect()] == ["I", "U", "D", None, None]


@pytest.mark.parametrize(
    ("address", "good"),
    [("juan@email.com", True), ("a.b+c@d-e.org", True), ("invalid-email", False), ("a@b.c", False), ("a b@c.de", False), (None, None)],
)
def test_email_shape(spark, address, good):
    df = spark.createDataFrame([(address,)], "v string")
    assert rows(df.select(text.looks_like_email(F.col("v")))) == [(good,)]


def test_recommendations_grow_with_the_data():
    small, large, huge = session.recommend(5), session.recommend(300), session.recommend(100_000)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert large["spark.sql.shuffle.partitions"] == "2400"
    assert huge["spark.sql.shuffle.partitions"] == "800000"
    assert huge["spark.sql.autoBroadcastJoinThreshold"] == "-1"


def test_configure_applies(spark):
    before = {k: spark.conf.get(k) for k in session.recommend(1)}
    try:
        session.configure(spark, 50)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "400"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_checkpoint_folder_of_the_session_is_kept(spark):
    first = session.checkpoint_root(spark)
    assert session.checkpoint_root(spark) == first
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_ratios_of_very_small_and_very_large_operands(spark):
    pairs = [(1e-7, 2e-7, 0.5), (3e-30, 1e-29, 0.3), (1e20, 4e20, 0.25), (-1e25, 2e25, -0.5), (1.0, 3e-9, 333333333.333), (0.0, 1e-9, 0.0), (5e-9, 0.0, None)]
    pairs += [(float("nan"), 1.0, None), (float("inf"), 1.0, None), (1e-20, 1.0, 0.0), (2.5e-7, 1e-3, 0.0), (1.2345678, 1.0, 1.235)]
    df = spark.createDataFrame(pairs, "a double, b double, want double")
    for row in df.select(numbers.ratio(F.col("a"), F.col("b"), 3).alias("r"), "want", "a").collect():
        assert row.r == row.want or abs(row.r - row.want) < 1e-6, row
    wide = df.limit(1).select(F.expr("CAST(2e30 AS DECIMAL(38,0))").alias("a"), F.expr("CAST(8e30 AS DECIMAL(38,0))").alias("b"))
    assert wide.select(numbers.ratio(F.col("a"), F.col("b"))).head()[0] == 0.25
