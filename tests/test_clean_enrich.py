from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.operators import clean, enrich


def test_trim_and_defaults(spark):
    df = spark.createDataFrame([(" a ", None, None), ("b", 2, 1.5)], "s string, n int, x double")
    out = clean.fill_defaults(clean.trim_columns(df, ["s"]), {"n": 1, "x": 0})
    assert rows(out) == [("a", 1, 0.0), ("b", 2, 1.5)]
    assert out.schema["n"].dataType == df.schema["n"].dataType


def test_casts_count_what_they_lose(spark):
    df = spark.createDataFrame([("1", "2024-01-15"), ("x", "15/01/2024"), (None, None)], "n string, d string")
    out = clean.cast_columns(df, {"n": "int", "d": "date"})
    assert rows(out) == [(1, datetime.date(2024, 1, 15), 0), (None, None, 0), (None, None, 2)]


def test_case_normalisation(spark):
    df = spark.createDataFrame([(" juan GARCIA ", " X@Y.Com", " mx")], "n string, e string, c string")
    assert rows(clean.normalise_case(df, {"n": "title", "e": "lower", "c": "upper"})) == [("Juan Garcia", "x@y.com", "MX")]


def test_latest_breaks_ties(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("j", None, "z"), ("j", 1, "y"), (None, 1, "n")],
        "id string, ts int, v string",
    )
    assert rows(clean.latest_per_key(df, ["id"], "ts")) == [("j", 1, "y"), ("k", 2, "c"), (None, 1, "n")]
    assert rows(clean.latest_per_key(df, ["id"], "ts", ["v"])) == [("j", 1, "y"), ("k", 2, "c"), (None, 1, "n")]


def test_latest_of_identical_rows_keeps_one(spark):
    df = spark.createDataFrame([("k", 1)] * 500, "id string, ts int")
    assert rows(clean.latest_per_key(df, ["id"], "ts")) == [("k", 1)]


def test_total_is_unknown_when_an_input_is(spark):
    df = spark.createDataFrame([(2, Decimal("29.99")), (None, Decimal("1.00")), (-1, Decimal("149.99"))], "quantity int, unit_price decimal(18,2)")
    assert [r.total_amount for r in enrich.with_total(df).collect()] == [Decimal("59.98"), None, Decimal("-149.99")]


def test_flags_and_levels(spark):
    df = spark.createDataFrame([(" COMPLETED", 1000.01), ("pending", 1000.0), (None, 100.0)], "order_status string, v double")
    out = enrich.amount_level(enrich.with_completed_flag(df), "v")
    assert [(r.is_completed, r.category) for r in out.collect()] == [(True, "high"), (False, "medium"), (False, "low")]


def _inputs(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", 10), ("o2", "c9", 20), ("o3", None, 30)], "order_id string, customer_id string, total_amount int"
    ).withColumn("status", F.lit("completed"))
    customers = spark.createDataFrame(
        [("c1", "A", "a@b.com", "X", datetime.date(2023, 1, 1))],
        "customer_id string, name string, email string, country string, registration_date date",
    )
    payments = spark.createDataFrame(
        [
            ("p1", "o1", Decimal("4.00"), "paypal", datetime.date(2024, 1, 1), "completed"),
            ("p2", "o1", Decimal("6.00"), "credit_card", datetime.date(2024, 1, 2), "pending"),
        ],
        "payment_id string, order_id string, amount decimal(18,2), payment_method string, payment_date date, status string",
    )
    return orders, customers, enrich.with_payment_category(payments)


def test_enriched_orders_keep_join_semantics(spark):
    joined = enrich.enriched_orders(*_inputs(spark))
    assert joined.count() == 4
    assert [r.payment_id for r in joined.where("order_id = 'o1'").orderBy("payment_id").collect()] == ["p1", "p2"]
    assert joined.where("order_id = 'o3'").first().customer_name is None


def test_payments_per_order_do_not_multiply_orders(spark):
    orders, customers, payments = _inputs(spark)
    joined = enrich.enriched_orders(orders, customers, enrich.payments_per_order(payments))
    assert joined.count() == 3
    paid = joined.where("order_id = 'o1'").first()
    assert (paid.payment_amount, paid.payment_id, paid.payment_category) == (Decimal("10.00"), "p2", "card")


def test_inner_join_drops_unknown_customers(spark):
    orders, customers, _ = _inputs(spark)
    assert enrich.matching_rows(orders, customers, ["customer_id"]).count() == 1


def test_days_until(spark):
    df = spark.createDataFrame([(datetime.date(2023, 6, 15),), (None,)], "d date")
    out = enrich.days_until(df, {"tenure": "d"}, datetime.date(2024, 1, 28))
    assert [r.tenure for r in out.collect()] == [227, None]
