from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell.operators import features as ft
from tidewell.operators import ml, monitor
from tidewell.operators.quality import ExpectationError

D = datetime.date
TODAY = D(2024, 1, 28)


@pytest.fixture(scope="module")
def orders(spark):
    made = [
        ("o1", "c1", "p1", 2, "60.00", D(2024, 1, 15), "completed", "paypal"),
        ("o2", "c1", "p2", 1, "50.00", D(2024, 1, 20), "completed", "card"),
        ("o3", "c1", "p2", 4, "5.01", D(2024, 1, 21), "cancelled", "card"),
        ("o4", "c2", "p1", 3, "90.00", D(2024, 1, 10), "completed", None),
        ("o5", "c2", "p3", 1, "99.99", D(2024, 1, 25), "pending", "b"),
        ("o6", "c2", "p3", 1, "99.99", D(2024, 1, 25), "pending", "a"),
        ("o7", "c3", "p1", 2, "59.98", D(2023, 12, 29), "completed", "cash"),
        ("o8", "c4", "p1", 2, "59.98", D(2023, 12, 28), "completed", "cash"),
        ("o9", "c5", "p9", 1, "1.00", D(2024, 1, 27), "cancelled", None),
    ]
    schema = """order_id string, customer_id string, product_id string, quantity int, total_amount string, order_date date,
        order_status string, payment_method string"""
    return spark.createDataFrame(made, schema).select(
        "*",
        F.col("total_amount").cast("decimal(18,2)").alias("money"),
        F.lit(D(2023, 6, 15)).alias("registration_date"),
        F.concat(F.lit("name "), "customer_id").alias("customer_name"),
        F.lit("Chile").alias("customer_country"),
    ).drop("total_amount").withColumnRenamed("money", "total_amount")


def test_rfm(orders):
    found = {r.customer_id: r for r in ft.rfm(orders, TODAY).collect()}
    assert {c: r.recency_days for c, r in found.items()} == {"c1": 8, "c2": 18, "c3": 30, "c4": 31}
    assert (found["c1"].frequency, found["c1"].monetary_value, found["c1"].avg_order_value) == (2, Decimal("110.00"), Decimal("55.00"))
    assert (found["c1"].max_order_value, found["c1"].min_order_value) == (Decimal("60.00"), Decimal("50.00"))


def test_behaviour(orders):
    found = {r.customer_id: r for r in ft.behavioural(orders).collect()}
    one, two = found["c1"], found["c2"]
    assert (one.cancellation_rate, one.pending_rate, one.unique_products, one.avg_basket_size, one.total_items) == (33.33, 0.0, 2, 2.33, 7)
    assert (one.payment_methods_used, one.preferred_payment_method) == (2, "card")
    assert (two.payment_methods_used, two.preferred_payment_method, two.pending_rate) == (2, "a", 66.67)
    assert found["c5"].preferred_payment_method is None


def test_lifecycle(orders):
    row = ft.temporal(orders, TODAY).where("customer_id = 'c1'").first()
    assert (row.days_since_registration, row.days_since_first_order, row.days_since_last_order) == (227, 13, 7)
    assert (row.active_period_days, row.days_to_first_order) == (6, 214)
    assert row.purchase_velocity == round(3 / (227 / 30 + 1), 3)


def test_churn_threshold_is_strict(orders):
    assert rows(ft.churn_label(orders, TODAY)) == [("c1", 0), ("c2", 0), ("c3", 0), ("c4", 1)]
    assert rows(ft.churn_label(orders, TODAY, days=17))[1] == ("c2", 1)


def test_combined_features_and_defaults(orders):
    combined = ft.combine(
        ft.customer_base(orders), ft.rfm(orders, TODAY), ft.behavioural(orders), ft.temporal(orders, TODAY), ft.churn_label(orders, TODAY)
    )
    five = combined.where("customer_id = 'c5'").first()
    assert (five.recency_days, five.frequency, five.is_churned, five.max_order_value) == (999, 0, 1, 0)
    assert combined.count() == 5
    assert same(ft.feature_table(orders, TODAY), combined.drop("customer_name", "customer_country"))
    lean = ft.feature_table(orders, TODAY, drop_leaky=True)
    assert not set(ft.LEAKY) & set(lean.columns) and len(lean.columns) == 18


def test_feature_table_key_is_checked(spark, orders, tmp_path):
    table = ft.feature_table(orders, TODAY)
    ft.write_feature_table(table, str(tmp_path / "t"))
    assert same(spark.read.parquet(str(tmp_path / "t")), table)
    with pytest.raises(ExpectationError):
        ft.write_feature_table(table.unionAll(table), str(tmp_path / "u"))
    with pytest.raises(ExpectationError):
        ft.write_feature_table(table.withColumn("customer_id", F.lit(None).cast("string")), str(tmp_path / "v"))


@pytest.fixture(scope="module")
def separable(spark):
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    return spark.range(1500).select(
        i, (i % 3 == 0).cast("int").alias("label"), ((i % 3 == 0).cast("int") + noise).alias("x"), F.lit(7.0).alias("flat"),
        (noise * 5).alias("y"),
    )


INPUTS = ["x", "y", "flat"]


def _auc(scored):
    return ml.roc_auc(scored, "label", monitor.SCORE).first().roc_auc


def test_split_is_repeatable_and_stratified(separable):
    train, test = ml.stratified_split(separable, ["id"])
    assert train.count() + test.count() == 1500 and train.join(test, "id").isEmpty()
    assert same(ml.stratified_split(separable.repartition(5), ["id"])[0], train)
    shares = [train.where(f"label = {v}").count() / separable.where(f"label = {v}").count() for v in (0, 1)]
    assert all(abs(s - 0.8) < 0.05 for s in shares)


def test_zscore(separable):
    train, _ = ml.stratified_split(separable, ["id"])
    scaled = ml.zscore(train, ml.fit_zscore(train, INPUTS))
    stats = scaled.agg(F.avg("x"), F.stddev_pop("x"), F.max("flat")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9 and stats[2] == 0


@pytest.mark.parametrize(
    "pipeline",
    [
        ml.logistic_regression,
        lambda f, y: ml.random_forest(f, y, numTrees=10),
        lambda f, y: ml.gradient_boosting(f, y, maxIter=5, maxDepth=3),
    ],
    ids=["logistic", "forest", "boosting"],
)
def test_models_learn_a_separable_table(spark, separable, pipeline):
    train, test = ml.stratified_split(separable, ["id"])
    model = pipeline(INPUTS, "label").fit(ml.positive_weight(train, "label"))
    scored = ml.score(test, model, "m1", "Staging")
    assert _auc(scored) > 0.9
    assert {r.model_stage for r in scored.select("model_stage").distinct().collect()} == {"Staging"}
    report = ml.average_importance([ml.importance(spark, model, INPUTS)], 2).collect()
    assert report[0].feature == "x" and len(report) == 2


def test_weight_balances_the_labels(separable):
    weighted = ml.positive_weight(separable, "label").groupBy("label").agg(F.sum("_weight").alias("w"))
    assert {r.label: round(r.w) for r in weighted.collect()} == {0: 1000, 1: 1000}


def test_cross_validation_reports_every_parameter_set(separable):
    pipeline = ml.logistic_regression(INPUTS, "label", maxIter=10)
    model, report = ml.cross_validate(separable, pipeline, "label", ["id"], {"regParam": [0.01, 0.1]}, folds=3)
    assert sorted(r.params for r in report.collect()) == ["regParam=0.01", "regParam=0.1"]
    assert report.agg(F.min("auc_mean")).first()[0] > 0.9
    assert _auc(ml.score(separable, model.bestModel)) > 0.9


def test_metrics_of_a_known_table(spark):
    made = [(1, 1, 0.9)] * 3 + [(1, 0, 0.4)] + [(0, 1, 0.6)] * 2 + [(0, 0, 0.1)] * 4
    df = spark.createDataFrame(made, "label int, prediction int, score double")
    assert rows(ml.confusion(df, "label", "prediction")) == [(3, 2, 1, 4)]
    assert rows(ml.classification_metrics(df, "label", "prediction")) == [(0.7, 0.6, 0.75, 0.666667)]
    won = sum((p > n) + (p == n) / 2 for l, _, p in made if l for k, _, n in made if not k)
    assert ml.roc_auc(df, "label", "score").first().roc_auc == round(won / 24, 6)
    roc = ml.roc_points(df, "label", "score").orderBy(F.desc("threshold")).collect()
    assert [(r.false_positive_rate, r.true_positive_rate) for r in roc] == [(0.0, 0.75), (0.333333, 0.75), (0.333333, 1.0), (1.0, 1.0)]
    pr = ml.pr_points(df, "label", "score").orderBy(F.desc("threshold")).collect()
    assert [(r.precision, r.recall) for r in pr] == [(1.0, 0.75), (0.6, 0.75), (0.666667, 1.0), (0.4, 1.0)]


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.1)], "label int, prediction int, score double")
    assert rows(ml.classification_metrics(df, "label", "prediction")) == [(1.0, 0.0, 0.0, 0.0)]
    assert ml.roc_auc(df, "label", "score").first().roc_auc is None


def test_comparison_and_gate(spark):
    df = spark.createDataFrame([(1, 0.9, 0.1), (0, 0.2, 0.8), (1, 0.7, 0.9), (0, 0.1, 0.3)], "label int, a double, b double")
    assert [tuple(r) for r in ml.compare(df, "label", {"worse": "b", "better": "a"}).collect()] == [("better", 1.0), ("worse", 0.5)]
    measured = spark.createDataFrame([(0.75, 0.6, 0.5), (0.74, 0.9, 0.9), (None, 0.9, 0.9)], "roc_auc double, precision double, recall double")
    assert [r.promote for r in ml.promotion_gate(measured).collect()] == [True, False, False]


def test_udf_scoring_matches_the_rule(spark):
    df = spark.range(100).select("id", (F.col("id") / 100.0).alias("u"), F.lit(None).cast("int").alias("gap"))

    def load():
        return lambda batch: batch["u"].to_numpy()

    scored = ml.score_with_udf(df, ["u"], load, "rule")
    assert scored.where(F.col(monitor.SCORE) != F.round("u", 4)).isEmpty()
    assert scored.where("churn_risk = 'HIGH'").count() == 30


def test_monitoring(spark):
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") / 1000.0).alias(monitor.SCORE))
    df = df.withColumn("churn_risk", F.when(F.col(monitor.SCORE) >= 0.7, "HIGH").when(F.col(monitor.SCORE) >= 0.4, "MEDIUM").otherwise("LOW"))
    row = monitor.metrics(df, exact=True).first()
    assert (row.total_scored, row.count_high, row.count_medium, row.count_low, row.high_risk_rate) == (1000, 300, 300, 400, 30.0)
    assert monitor.score_distribution(df).first().total_customers == 1000
    top = monitor.high_risk_report(df, 3, columns=[monitor.SCORE]).collect()
    assert [r.customer_id for r in top] == [999, 998, 997]


def test_drift(spark):
    base = spark.range(1000).select((F.col("id") / 1000.0).alias(monitor.SCORE))
    calm = monitor.drift(base, base.orderBy(F.desc(monitor.SCORE))).first()
    assert (calm.mean_change, calm.stability_index, calm.drift_alert) == (0.0, 0.0, False)
    shifted = base.select((F.col(monitor.SCORE) / 2 + 0.5).alias(monitor.SCORE))
    loud = monitor.drift(base, shifted).first()
    assert loud.mean_change == 0.25025 and loud.stability_index > 1 and loud.drift_alert


def test_churn_queries_fit_whole_models(spark, monkeypatch):
    """The library's own defaults, which are the reference's, and the reference's grid."""
    from unittest.mock import MagicMock

    from tidewell.plans import churn

    made, validated = [], []
    for kind in ("random_forest", "gradient_boosting", "logistic_regression"):
        monkeypatch.setattr(churn.ml, kind, lambda *a, **options: made.append(options))
    monkeypatch.setattr(churn.ml, "cross_validate", lambda *a, **options: validated.append((a[4:], options)) or (None, None))
    monkeypatch.setattr(churn.ml, "stratified_split", lambda *a: (None, None))
    for name in ("_training", "_evaluated", "scratch_dir"):
        monkeypatch.setattr(churn, name, MagicMock())
    monkeypatch.setattr(churn, "_fitted", lambda *a, **k: (None, None))
    for name in ("importance", "average_importance", "score", "save", "load"):
        monkeypatch.setattr(churn.ml, name, MagicMock())
    queries = ["random_forest", "gradient_boosting", "cross_validation", "grid_search", "feature_importance", "scored_customers", "scored_from_stored_model"]
    for name in queries:
        getattr(churn, name)(spark, "")
    assert made == [{}] * 8
    assert validated == [((), {}), (({"numTrees": [50, 100], "maxDepth": [5, 10]},), {"parallelism": 4})]


@pytest.mark.parametrize("name", ["feature_importance", "scored_customers", "scored_from_stored_model"])
def test_training_table_is_made_once_per_query(spark, monkeypatch, name):
    from unittest.mock import MagicMock

    from tidewell.plans import churn

    for stub in ("ml", "scratch_dir", "_training"):
        monkeypatch.setattr(churn, stub, MagicMock())
    churn.ml.stratified_split.return_value = (MagicMock(), MagicMock())
    getattr(churn, name)(spark, "")
    assert churn._training.call_count == 1


def test_a_forest_keeps_the_nodes_its_rows_have_reached(spark):
    """Rows are not sent through all trees again at every level, and the trees are those that this would give."""
    made = spark.range(3_000, numPartitions=3).select(
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1_000)) / 1_000).alias(f"x{i}") for i in range(6)], "id"
    ).withColumn("y", (F.col("x0") + F.col("x1") * F.col("x2") + F.pmod(F.xxhash64("id", F.lit(9)), F.lit(3)) * 0.2 > 1).cast("int")).cache()
    inputs = [f"x{i}" for i in range(6)]
    forest = ml.random_forest(inputs, "y", numTrees=12, maxDepth=12)
    assert forest.getStages()[-1].getCacheNodeIds()
    plain = ml.random_forest(inputs, "y", numTrees=12, maxDepth=12, cacheNodeIds=False)
    trees = [pipeline.fit(made).stages[-1].toDebugString.split("\n", 1)[1] for pipeline in (forest, plain)]
    assert trees[0] == trees[1] and trees[0].count("If") > 200
