from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell.operators import quality as q


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [
            ("o1", "c1", 2, 29.99, "completed", "a@b.com"),
            ("o2", None, -1, 149.99, "completed", "bad"),
            ("o2", "c1", 0, math.nan, "odd", None),
            (None, "c2", None, None, None, ""),
            (None, "c3", 101, 0.0, "pending", "x@y.org"),
        ],
        "order_id string, customer_id string, quantity int, price double, status string, email string",
    )


def _failed(df, rules):
    return {(r.rule_name, r.column): r.failed_records for r in q.validate(df, rules).collect()}


def test_rule_semantics(spark, df):
    known = spark.createDataFrame([("c1",), ("c1",), ("c2",), (None,)], "id string")
    rules = (
        q.not_null("order_id", "price")
        + q.unique("order_id", "customer_id")
        + q.positive("quantity", "price")
        + q.between("quantity", 0, 100)
        + q.in_set("status", ["completed", "pending"])
        + q.email("email")
        + q.length("email", low=0, high=5)
        + q.references("customer_id", known, "id")
    )
    assert _failed(df, rules) == {
        ("not_null", "order_id"): 2,
        ("not_null", "price"): 2,
        ("unique", "order_id"): 2,
        ("unique", "customer_id"): 1,
        ("positive", "quantity"): 2,
        ("positive", "price"): 1,
        ("range", "quantity"): 2,
        ("in_set", "status"): 1,
        ("regex", "email"): 2,
        ("length", "email"): 2,
        ("referential_integrity", "customer_id"): 2,
    }


def test_length_bound_zero_counts(df):
    assert _failed(df, q.length("email", high=0)) == {("length", "email"): 3}


def test_result_row(df):
    row = q.validate(df, q.not_null("order_id")).first()
    assert row.asDict() == {
        "rule_name": "not_null",
        "column": "order_id",
        "level": "error",
        "passed": False,
        "total_records": 5,
        "failed_records": 2,
        "failure_rate": 40.0,
        "message": "Column 'order_id' has 2 null values",
    }


def test_empty_table_passes(df):
    results = q.validate(df.where("false"), q.not_null("order_id") + q.unique("order_id"))
    assert {(r.passed, r.total_records, r.failure_rate) for r in results.collect()} == {(True, 0, 0.0)}


@pytest.mark.parametrize(
    ("levels", "status"), [((q.ERROR, q.INFO), "FAILED"), ((q.WARNING, q.INFO), "PASSED"), ((q.INFO, q.INFO), "PASSED")]
)
def test_summary_status(df, levels, status):
    rules = q.not_null("order_id", level=levels[0]) + q.in_set("status", ["completed"], level=levels[1]) + q.between("quantity", -5, 500)
    row = q.summary(q.validate(df, rules)).first()
    assert (row.total_rules, row.passed_rules, row.failed_rules, row.pass_rate, row.status) == (3, 1, 2, 33.33, status)
    assert row.errors == (levels[0] == q.ERROR) and row.warnings == (levels[0] == q.WARNING)


def test_rules_from_configuration(df):
    config = [
        {"column": "order_id", "rule": "not_null"},
        {"column": "quantity", "rule": "range", "min": 0, "max": 100, "level": "warning"},
        {"column": "email", "rule": "email"},
    ]
    results = q.validate(df, q.from_config(config))
    assert [(r.rule_name, r.level) for r in results.orderBy("rule_name").collect()] == [
        ("not_null", "error"), ("range", "warning"), ("regex", "warning"),
    ]
    assert q.alerts(results, 0.39).count() == 3 and q.alerts(results, 0.4).count() == 0
    with pytest.raises(ValueError):
        q.from_config([{"column": "x", "rule": "vibes"}])


def test_breaches_by_kind_and_size(df):
    results = q.validate(df, q.not_null("customer_id") + q.unique("order_id") + q.positive("quantity"))
    assert {r.rule_name for r in q.breaches(results, {"not_null": 0.2, "unique": 0.0}, 5).collect()} == {"unique"}
    assert q.breaches(results, {}, 6).count() == 3


def test_history_is_stamped(df):
    at = datetime.datetime(2024, 1, 1)
    assert q.stamped(q.validate(df, q.not_null("order_id")), at).first().validation_timestamp == at


def test_all_rules_of_a_table_take_one_pass(spark, df):
    rules = q.not_null(*df.columns) + q.unique("order_id", "customer_id") + q.positive("quantity")
    text = q.validate(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1




def test_expectations(df):
    rules = {"known": "customer_id IS NOT NULL", "some": F.col("quantity") > 0}
    kept, metrics = q.expect(df, rules, "warn")
    assert kept.count() == 5
    assert rows(metrics) == [("known", 4, 1), ("some", 2, 3)]
    dropped, _ = q.expect(df, rules, "drop")
    assert sorted(r.customer_id for r in dropped.collect()) == ["c1", "c3"]
    with pytest.raises(q.ExpectationError, match="known: 1 rows, some: 3 rows"):
        q.expect(df, rules, "fail")
    q.expect(df, {"fine": "true"}, "fail")
    with pytest.raises(ValueError):
        q.expect(df, rules, "explode")


def test_observed_expectations_need_no_pass_of_their_own(df):
    seen = Observation("orders")
    q.observe_expectations(df, {"known": "customer_id IS NOT NULL", "some": "quantity > 0"}, seen).count()
    assert seen.get == {"total": 5, "known": 1, "some": 3}


def test_quarantine_is_an_exact_partition(df):
    rules = {"known": "customer_id IS NOT NULL", "some": "quantity > 0", "status": "status IN ('completed', 'pending')"}
    valid, quarantined = q.split(df, rules, datetime.datetime(2024, 1, 1))
    assert same(valid.unionAll(quarantined.select(*df.columns)), df)
    reasons = {tuple(r.reasons) for r in quarantined.collect()}
    assert reasons == {("known", "some"), ("some", "status")}
    assert valid.count() == 2


def test_profile_and_describe(df):
    exact = {r.column: r for r in q.profile(df, ["order_id", "quantity"], exact=True).collect()}
    assert (exact["order_id"].row_count, exact["order_id"].null_count, exact["order_id"].distinct_count) == (5, 2, 2)
    assert (exact["quantity"].min_value, exact["quantity"].max_value) == ("-1", "101")
    near = {r.column: r.distinct_count for r in q.profile(df).collect()}
    assert near["customer_id"] == 3
    stats = q.describe(df, ["quantity"]).first()
    assert (stats["count"], stats["min"], stats["max"], stats["mean"]) == (4, -1.0, 101.0, 25.5)


def test_orphans_and_matches_split_the_table(spark, df):
    known = spark.createDataFrame([("c1",), ("c1",)], "id string")
    lost, found = q.orphans(df, "customer_id", known, "id"), q.matched_rows(df, "customer_id", known, "id")
    assert (lost.count(), found.count()) == (3, 2)
