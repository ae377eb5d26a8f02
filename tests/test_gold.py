from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell.operators import gold
from tidewell.operators.ordered import global_ranks, range_bucket

D = datetime.date
M = Decimal
COLUMNS = """order_id string, customer_id string, customer_name string, customer_email string, customer_country string,
    registration_date date, product_id string, quantity int, unit_price decimal(18,2), total_amount decimal(18,2),
    order_date date, order_status string, payment_id string, payment_amount decimal(18,2), payment_method string,
    payment_category string, payment_status string"""


@pytest.fixture(scope="module")
def orders(spark):
    a = ("c1", "Ann", "ann@x.org", "Chile", D(2023, 6, 1))
    b = ("c2", "Bob", "bob@x.org", "Peru", D(2023, 9, 1))
    cash, card = ("cash", "other"), ("credit_card", "card")
    data = [
        ("o1", *a, "p1", 2, M("10.00"), M("20.00"), D(2024, 1, 1), "completed", "y1", M("20.00"), *card, "completed"),
        ("o2", *a, "p2", 1, M("50.05"), M("50.05"), D(2024, 1, 1), "completed", "y2", M("40.00"), *cash, "pending"),
        ("o3", *b, "p1", 3, M("10.00"), M("30.00"), D(2024, 1, 2), "completed", None, None, None, None, None),
        ("o4", *b, "p3", 1, M("500.00"), M("500.00"), D(2024, 1, 3), "cancelled", None, None, None, None, None),
        ("o5", *b, "p2", 1, M("50.05"), M("50.05"), D(2024, 1, 2), "completed", "y5", M("50.05"), *card, "completed"),
        ("o6", *a, "p2", None, None, None, D(2024, 1, 2), "completed", None, None, None, None, None),
    ]
    return spark.createDataFrame(data, COLUMNS)


def test_daily_revenue(orders):
    assert rows(gold.daily_revenue(orders)) == [
        (D(2024, 1, 1), 2, 1, M("70.05"), M("60.00"), M("35.03"), 3, 85.65),
        (D(2024, 1, 2), 3, 2, M("80.05"), M("50.05"), M("40.03"), 4, 62.52),
    ]
    assert [r.order_date.day for r in gold.newest_first(gold.daily_revenue(orders)).collect()] == [2, 1]


def test_country_revenue(orders):
    found = {r.customer_country: r for r in gold.country_revenue(orders).collect()}
    assert found["Peru"].total_revenue == M("80.05") and found["Peru"].revenue_rank == 1
    assert found["Chile"].total_customers == 1 and found["Chile"].total_orders == 3
    assert (found["Peru"].revenue_percentile, found["Chile"].revenue_percentile) == (0.0, 100.0)


def test_top_products(orders):
    found = {r.product_id: r for r in gold.top_products(orders).collect()}
    assert set(found) == {"p1", "p2"}
    assert (found["p2"].total_revenue, found["p2"].revenue_rank, found["p2"].units_rank) == (M("100.10"), 1, 2)
    assert (found["p1"].total_units_sold, found["p1"].unique_buyers, found["p1"].avg_unit_price) == (5, 2, M("10.00"))


def test_customer_360(orders):
    found = {r.customer_id: r for r in gold.customer_360(orders, D(2024, 1, 18)).collect()}
    bob = found["c2"]
    assert (bob.total_orders, bob.completed_orders, bob.cancelled_orders, bob.pending_orders) == (3, 2, 1, 0)
    assert (bob.total_spent, bob.customer_segment, bob.completion_rate) == (M("580.05"), "Premium", 66.67)
    assert (bob.days_since_last_order, bob.churn_risk) == (15, "Medium")
    assert (found["c1"].customer_segment, found["c1"].tenure_days) == ("Occasional", 231)


def test_payments(orders):
    assert rows(gold.payment_metrics(orders)) == [("credit_card", "card", 2, M("70.05"), M("50.05"), M("20.00"), M("35.03"))]
    assert rows(gold.payment_success(orders)) == [
        ("cash", 1, M("50.05"), M("50.05"), 0.0),
        ("credit_card", 2, M("70.05"), M("35.03"), 100.0),
    ]


def test_executive_summary(orders):
    row = gold.executive_summary(orders, as_of=D(2024, 1, 18)).first()
    assert (row.total_revenue, row.total_orders, row.total_customers) == (M("150.10"), 5, 2)
    assert (row.top_country, row.top_product, row.avg_order_value) == ("Peru", "p2", M("37.53"))
    assert row.report_date == D(2024, 1, 18)


def test_group_stats_and_counts(orders):
    found = {r.product_id: r for r in gold.group_stats(orders, "product_id", "total_amount").collect()}
    assert (found["p2"].total, found["p2"]["count"], found["p2"].average) == (M("100.10"), 3, 50.05)
    assert rows(gold.counts_by(orders, ["order_status"])) == [("cancelled", 1), ("completed", 5)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers(-(10**6), 10**6)), min_size=1, max_size=60), st.integers(1, 9))
@example([0], 1)
@example([None, None], 4)
def test_ranks_do_not_depend_on_the_route(spark, values, slots):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v long")
    options = {"ranks": {"r": "v"}, "percents": {"p": "v"}}
    plain = global_ranks(df, **options)
    split = global_ranks(df, **options, one_task_rows=0, slots=slots)
    assert same(plain, split)


def test_ranks_with_one_value_holding_a_third(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("decimal(18,2)").alias("v"))
    assert same(global_ranks(df, {"r": "v"}, {"p": "v"}), global_ranks(df, {"r": "v"}, {"p": "v"}, one_task_rows=0, slots=8))


def test_range_bucket_counts_cuts_at_or_below(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 1, 5, 9, None)], "v int")
    assert [r[0] for r in df.select(range_bucket(F.col("v"), [0, 1, 2, 9])).collect()] == [0, 1, 2, 3, 4, 0]
    assert [r[0] for r in df.select(range_bucket(F.col("v"), [])).collect()] == [0] * 6
