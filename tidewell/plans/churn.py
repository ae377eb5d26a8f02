"""Customer features, models, evaluation and score monitoring."""

from __future__ import annotations

import datetime


from pyspark.sql import functions as F

from tidewell import catalog, sources
from tidewell.functions import labels
from tidewell.functions.numbers import money
from tidewell.operators import features as ft
from tidewell.operators import gold, ml, monitor, quality
from tidewell.plans import sql
from tidewell.plans.registry import Registry
from tidewell.session import durable, scratch_dir, stored

R = Registry()
# Days without a completed order that count as churn in the training queries.
TRAINING_DAYS = 365

# --- features ---------------------------------------------------------------------------------

_TODAY = "DATE '2001-08-02'"
_RFM = f"""SELECT customer_id, CAST({_TODAY} - MAX(order_date) AS INT) AS recency_days, COUNT(order_id) AS frequency,
        {sql.dbl(sql.total('total_amount'))} AS monetary_value,
        {sql.mean_money(sql.total('total_amount'), 'COUNT(total_amount)')} AS avg_order_value,
        {sql.dbl('MAX(total_amount)')} AS max_order_value, {sql.dbl('MIN(total_amount)')} AS min_order_value
    FROM rich WHERE order_status = 'completed' GROUP BY 1"""
_METHODS = """SELECT customer_id, arg_min(payment_method, (-n, payment_method)) AS preferred_payment_method FROM (
        SELECT customer_id, payment_method, COUNT(*) AS n FROM rich WHERE payment_method IS NOT NULL GROUP BY ALL) GROUP BY 1"""
_VARIETY = "SELECT customer_id, COUNT(DISTINCT product_id) AS unique_products FROM lines GROUP BY 1"
_BEHAVIOUR = f"""SELECT b.customer_id, {sql.percent('cancelled', 'n')} AS cancellation_rate,
        {sql.percent('pending', 'n')} AS pending_rate, COALESCE(unique_products, 0) AS unique_products,
        {sql.ratio('items', 'baskets', 2)} AS avg_basket_size, items AS total_items, payment_methods_used,
        preferred_payment_method
    FROM (SELECT customer_id, COUNT(order_id) AS n, COUNT(*) FILTER (order_status = 'cancelled') AS cancelled,
              COUNT(*) FILTER (order_status = 'pending') AS pending, {sql.big('SUM(quantity)')} AS items,
              COUNT(quantity) AS baskets, COUNT(DISTINCT payment_method) AS payment_methods_used
          FROM rich GROUP BY 1) b
    LEFT JOIN variety USING (customer_id) LEFT JOIN methods USING (customer_id)"""
_LIFE = f"""SELECT customer_id, tenure AS days_since_registration, first_days AS days_since_first_order,
        last_days AS days_since_last_order, first_days - last_days AS active_period_days,
        {sql.ratio('n * 30', '(tenure + 30)', 3)} AS purchase_velocity, tenure - first_days AS days_to_first_order
    FROM (SELECT customer_id, CAST({_TODAY} - MIN(registration_date) AS INT) AS tenure,
              CAST({_TODAY} - MIN(order_date) AS INT) AS first_days, CAST({_TODAY} - MAX(order_date) AS INT) AS last_days,
              COUNT(order_id) AS n FROM rich GROUP BY 1)"""
_CHURN = f"""SELECT customer_id, CAST({_TODAY} - MAX(order_date) > 30 AS INT) AS is_churned
    FROM rich WHERE order_status = 'completed' GROUP BY 1"""
_GROUPS = {
    "variety": _VARIETY, "methods": _METHODS, "rfm": _RFM, "behaviour": _BEHAVIOUR, "life": _LIFE, "churn": _CHURN,
}
_DEFAULTED = ", ".join(
    f"COALESCE({c}, {999 if c == 'recency_days' else 1 if c == 'is_churned' else 0}) AS {c}"
    for c in [*ft.FEATURES, "is_churned"]
)
_TABLE = f"""SELECT customer_id, {_DEFAULTED} FROM (SELECT DISTINCT customer_id FROM rich)
    LEFT JOIN rfm USING (customer_id) LEFT JOIN behaviour USING (customer_id)
    LEFT JOIN life USING (customer_id) LEFT JOIN churn USING (customer_id)"""


@R.add(sql.query("rich", _RFM))
def rfm_features(spark, folder):
    return ft.rfm(catalog.enriched(spark, folder), catalog.AS_OF)


@R.add(sql.query("rich lines", _BEHAVIOUR, variety=_VARIETY, methods=_METHODS))
def behavioural_features(spark, folder):
    return ft.behavioural(catalog.enriched(spark, folder), catalog.order_lines(spark, folder))


@R.add(sql.query("rich", _LIFE))
def temporal_features(spark, folder):
    return ft.temporal(catalog.enriched(spark, folder), catalog.AS_OF)


@R.add(sql.query("rich", _CHURN))
def churn_labels(spark, folder):
    return ft.churn_label(catalog.enriched(spark, folder), catalog.AS_OF)


@R.add(sql.query("rich", "SELECT is_churned, COUNT(*) AS count FROM churn GROUP BY 1", churn=_CHURN))
def churn_distribution(spark, folder):
    return gold.counts_by(ft.churn_label(catalog.enriched(spark, folder), catalog.AS_OF), ["is_churned"])


@R.add(sql.query("rich lines", f"""SELECT t.*, customer_name, customer_country FROM ({_TABLE}) t
    JOIN (SELECT customer_id, ANY_VALUE(customer_name) AS customer_name, ANY_VALUE(customer_country) AS customer_country
          FROM rich GROUP BY 1) USING (customer_id)""", **_GROUPS))
def combined_features(spark, folder):
    # Five groups of features look at the enriched orders: they are joined once.
    rich, lines = stored(catalog.enriched(spark, folder), "enriched"), catalog.order_lines(spark, folder)
    return ft.combine(
        ft.customer_base(rich), ft.rfm(rich, catalog.AS_OF), ft.behavioural(rich, lines),
        ft.temporal(rich, catalog.AS_OF), ft.churn_label(rich, catalog.AS_OF),
    )


def _features(spark, folder, **options):
    rich, lines = catalog.enriched(spark, folder), catalog.order_lines(spark, folder)
    return ft.feature_table(rich, catalog.AS_OF, lines, **options)


@R.add(sql.query("rich lines", _TABLE, **_GROUPS))
def feature_table(spark, folder):
    return _features(spark, folder)


@R.add(sql.query("rich lines", _TABLE, **_GROUPS))
def stored_feature_table(spark, folder):
    path = scratch_dir(spark, "features")
    ft.write_feature_table(_features(spark, folder), path)
    return sources.read_parquet(spark, path)


def _feature_rule(kind: str, column: str, bad: str) -> str:
    return f"""SELECT '{kind}' AS rule_name, '{column}' AS "column", COUNT(*) FILTER ({bad}) AS failed_records FROM t"""


@R.add(sql.query("rich lines", " UNION ALL ".join([
    _feature_rule("not_null", "customer_id", "customer_id IS NULL"),
    *[_feature_rule("positive", c, f"{c} <= 0") for c in ("recency_days", "frequency", "monetary_value")],
    _feature_rule("range", "cancellation_rate", "cancellation_rate < 0 OR cancellation_rate > 100"),
]), **_GROUPS, t=_TABLE))
def feature_rules(spark, folder):
    results = quality.validate(_features(spark, folder), quality.from_config(ft.FEATURE_RULES))
    return results.select("rule_name", "column", "failed_records")


# --- scored documents: label = quality, score = n / (n + 10,000) for n characters ----------------------

_SCORED = """SELECT doc_id, quality AS label, CAST(n_chars AS DOUBLE) / (n_chars + 10000) AS score,
        CAST(n_chars AS DOUBLE) / (n_chars + 1000) AS steep_score,
        CAST(n_chars >= 1000 AS INT) AS prediction
    FROM labels JOIN documents USING (doc_id)"""
_CONFUSION = """SELECT COUNT(*) FILTER (label = 1 AND prediction = 1) AS true_positive,
        COUNT(*) FILTER (label <> 1 AND prediction = 1) AS false_positive,
        COUNT(*) FILTER (label = 1 AND prediction <> 1) AS false_negative,
        COUNT(*) FILTER (label <> 1 AND prediction <> 1) AS true_negative FROM scored"""
_TP, _FP, _FN, _TN = "true_positive", "false_positive", "false_negative", "true_negative"
_METRICS = f"""SELECT COALESCE({sql.ratio(f'({_TP} + {_TN})', f'({_TP} + {_TN} + {_FP} + {_FN})', 6)}, 0) AS accuracy,
        COALESCE({sql.ratio(_TP, f'({_TP} + {_FP})', 6)}, 0) AS precision,
        COALESCE({sql.ratio(_TP, f'({_TP} + {_FN})', 6)}, 0) AS recall,
        COALESCE({sql.ratio(f'(2 * {_TP})', f'(2 * {_TP} + {_FP} + {_FN})', 6)}, 0) AS f1_score FROM confusion"""


def _groups_sql(score: str) -> str:
    return f"""SELECT {score} AS threshold, COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label = 0) AS n
        FROM scored GROUP BY 1"""


def _auc_sql(score: str) -> str:
    """Every positive against every negative, by groups of equal score."""
    return f"""SELECT round(SUM(a.p * b.n * CASE WHEN a.threshold > b.threshold THEN 1.0::DOUBLE
            WHEN a.threshold = b.threshold THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) / (SUM(a.p * b.n)), 6) AS roc_auc
        FROM ({_groups_sql(score)}) a, ({_groups_sql(score)}) b"""


_CURVE = """SELECT threshold, CAST(SUM(p) OVER w AS BIGINT) AS tp, CAST(SUM(n) OVER w AS BIGINT) AS fp,
        CAST(SUM(p) OVER () AS BIGINT) AS all_p, CAST(SUM(n) OVER () AS BIGINT) AS all_n
    FROM g WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)"""
_VIEWS = {"scored": _SCORED}


def _scored(spark, folder):
    length = F.col("n_chars")
    return (
        catalog.table(spark, folder, "labels")
        .join(catalog.table(spark, folder, "documents").select("doc_id", "n_chars"), ["doc_id"])
        .select(
            "doc_id",
            F.col("quality").alias("label"),
            (length / (length + 10_000)).alias("score"),
            (length / (length + 1_000)).alias("steep_score"),
            (length >= 1000).cast("int").alias("prediction"),
        )
    )


@R.add(sql.query("", _CONFUSION, **_VIEWS))
def confusion_matrix(spark, folder):
    return ml.confusion(_scored(spark, folder), "label", "prediction")


@R.add(sql.query("", _METRICS, **_VIEWS, confusion=_CONFUSION))
def classification_metrics(spark, folder):
    return ml.classification_metrics(_scored(spark, folder), "label", "prediction")


@R.add(sql.query("", _auc_sql("score"), **_VIEWS))
def roc_auc(spark, folder):
    return ml.roc_auc(_scored(spark, folder), "label", "score")


@R.add(sql.query("", f"""SELECT threshold, {sql.ratio('fp', 'all_n', 6)} AS false_positive_rate,
    {sql.ratio('tp', 'all_p', 6)} AS true_positive_rate FROM c""", **_VIEWS, g=_groups_sql("score"), c=_CURVE))
def roc_points(spark, folder):
    return ml.roc_points(_scored(spark, folder), "label", "score")


@R.add(sql.query("", f"""SELECT threshold, {sql.ratio('tp', '(tp + fp)', 6)} AS precision,
    {sql.ratio('tp', 'all_p', 6)} AS recall FROM c""", **_VIEWS, g=_groups_sql("score"), c=_CURVE))
def precision_recall_points(spark, folder):
    return ml.pr_points(_scored(spark, folder), "label", "score")


@R.add(sql.query("", f"""SELECT 'plain' AS model, roc_auc FROM ({_auc_sql('score')})
    UNION ALL SELECT 'steep', roc_auc FROM ({_auc_sql('steep_score')})""", **_VIEWS))
def model_comparison(spark, folder):
    return ml.compare(_scored(spark, folder), "label", {"plain": "score", "steep": "steep_score"})


@R.add(sql.query("", f"""SELECT *, roc_auc >= 0.75 AND precision >= 0.60 AND recall >= 0.50 AS promote
    FROM ({_METRICS}), ({_auc_sql('score')})""", **_VIEWS, confusion=_CONFUSION))
def promotion_gate(spark, folder):
    scored = _scored(spark, folder)
    area = ml.roc_auc(scored, "label", "score")
    measured = ml.classification_metrics(scored, "label", "prediction")
    return ml.promotion_gate(measured.select("*", area.scalar().alias("roc_auc")))


@R.add(f"""WITH s AS (SELECT AVG(CAST(o_totalprice AS {sql.MONEY})) AS m, STDDEV_POP(o_totalprice) AS d FROM orders)
    SELECT o_orderkey, round((o_totalprice - (SELECT m FROM s)) / (SELECT d FROM s), 5) AS o_totalprice FROM orders""")
def standard_scores(spark, folder):
    orders = catalog.table(spark, folder, "orders").select("o_orderkey", money(F.col("o_totalprice")).alias("o_totalprice"))
    scaled = ml.zscore(orders, ml.fit_zscore(orders, ["o_totalprice"]))
    return scaled.withColumn("o_totalprice", F.round("o_totalprice", 5))


# --- monitoring: risk classes of document scores ------------------------------------------------

_RISKS = """SELECT *, CASE WHEN steep_score >= 0.7 THEN 'HIGH' WHEN steep_score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk
    FROM (SELECT doc_id, lang, CAST(n_chars AS DOUBLE) / (n_chars + 1000) AS steep_score FROM documents)"""


def _risks(spark, folder):
    steep = (F.col("n_chars") / (F.col("n_chars") + 1_000)).alias("steep_score")
    scored = catalog.table(spark, folder, "documents").select("doc_id", "lang", steep)
    return scored.withColumn("churn_risk", labels.score_risk(F.col("steep_score")))


@R.add(sql.query("", """SELECT COUNT(*) AS total_customers, round(AVG(steep_score), 6) AS avg_probability,
    MIN(steep_score) AS min_probability, MAX(steep_score) AS max_probability,
    round(quantile_cont(steep_score, 0.5), 6) AS median_probability FROM risks""", risks=_RISKS))
def score_distribution(spark, folder):
    found = monitor.score_distribution(_risks(spark, folder), "steep_score", exact=True)
    return found.withColumns({c: F.round(c, 6) for c in ("avg_probability", "median_probability")})


@R.add(sql.query("", "SELECT * FROM risks", risks=_RISKS))
def stored_predictions(spark, folder):
    path = scratch_dir(spark, "predictions")
    monitor.save_predictions(_risks(spark, folder), path)
    return sources.read_parquet(spark, path)


@R.add(sql.query("", "SELECT churn_risk, COUNT(*) AS count FROM risks GROUP BY 1", risks=_RISKS))
def risk_distribution(spark, folder):
    return monitor.risk_distribution(_risks(spark, folder))


@R.add(sql.query("", f"""SELECT COUNT(*) AS total_scored, COUNT(*) FILTER (churn_risk = 'HIGH') AS count_high,
    COUNT(*) FILTER (churn_risk = 'MEDIUM') AS count_medium, COUNT(*) FILTER (churn_risk = 'LOW') AS count_low,
    round(AVG(steep_score), 6) AS avg_churn_probability, round(quantile_cont(steep_score, 0.25), 6) AS p25_probability,
    round(quantile_cont(steep_score, 0.5), 6) AS p50_probability, round(quantile_cont(steep_score, 0.75), 6) AS p75_probability,
    {sql.percent("COUNT(*) FILTER (churn_risk = 'HIGH')", 'COUNT(*)')} AS high_risk_rate FROM risks""", risks=_RISKS))
def monitoring_metrics(spark, folder):
    return monitor.metrics(_risks(spark, folder), "steep_score", exact=True, places=6)


@R.add(sql.query("", """SELECT doc_id, steep_score, lang FROM risks WHERE churn_risk = 'HIGH'
    ORDER BY steep_score DESC, doc_id LIMIT 50""", risks=_RISKS))
def high_risk_report(spark, folder):
    return monitor.high_risk_report(_risks(spark, folder), 50, "doc_id", "steep_score", ["steep_score", "lang"])


@R.add(sql.query("", """SELECT DATE '2024-02-01' AS report_date, doc_id, steep_score, lang FROM risks WHERE churn_risk = 'HIGH'
    ORDER BY steep_score DESC, doc_id LIMIT 20""", risks=_RISKS))
def stored_risk_report(spark, folder):
    """The report as stored: a later run for the same day replaces the day's rows and no others."""
    path, scored = scratch_dir(spark, "reports"), _risks(spark, folder)
    for day, n in ((datetime.date(2024, 1, 31), 5), (datetime.date(2024, 2, 1), 50), (datetime.date(2024, 2, 1), 20)):
        report = monitor.high_risk_report(scored, n, "doc_id", "steep_score", ["steep_score", "lang"])
        monitor.save_report(report, path, day)
    return monitor.stored_reports(spark, path, datetime.date(2024, 2, 1))


@R.add(sql.query("", """
    SELECT SUM(b)::BIGINT AS base_records, SUM(c)::BIGINT AS current_records,
           round(SUM(cs) / SUM(c) - SUM(bs) / SUM(b), 6) AS mean_change, round(SUM((cp - bp) * ln(cp / bp)), 6) AS stability_index,
           abs(round(SUM(cs) / SUM(c) - SUM(bs) / SUM(b), 6)) > 0.1::DOUBLE
               OR round(SUM((cp - bp) * ln(cp / bp)), 6) > 0.1::DOUBLE AS drift_alert
    FROM (SELECT *, greatest(b / SUM(b) OVER (), 1e-6::DOUBLE) AS bp, greatest(c / SUM(c) OVER (), 1e-6::DOUBLE) AS cp FROM bins)""",
    risks=_RISKS, bins="""SELECT least(floor(steep_score * 10), 9) AS bin,
        COUNT(*) FILTER (lang = 'en') AS b, COUNT(*) FILTER (lang <> 'en') AS c,
        COALESCE(SUM(steep_score) FILTER (lang = 'en'), 0) AS bs, COALESCE(SUM(steep_score) FILTER (lang <> 'en'), 0) AS cs
        FROM risks GROUP BY 1"""))
def score_drift(spark, folder):
    """English documents against all others."""
    risks = _risks(spark, folder)
    return monitor.drift(risks.where(F.col("lang") == "en"), risks.where(F.col("lang") != "en"), "steep_score")


# --- models over the customer features ----------------------------------------------------------

_INPUTS = [c for c in ft.FEATURES if c not in ft.LEAKY]


def _training(spark, folder):
    """Features without the ones that give the label away, materialised."""
    table = _features(spark, folder, days=TRAINING_DAYS, drop_leaky=True)
    typed = table.select("customer_id", *[F.col(c).cast("double").alias(c) for c in _INPUTS], "is_churned")
    return durable(typed)


def _fitted(pipeline, spark, folder, weighted=False, table=None):
    """The model and the test rows; ``table`` is the training table, if it is there already."""
    train, test = ml.stratified_split(_training(spark, folder) if table is None else table, ["customer_id"])
    return pipeline.fit(ml.positive_weight(train, "is_churned") if weighted else train), test


def _evaluated(model, test):
    scored = ml.score(test, model)
    judged = scored.withColumn("prediction", (F.col(monitor.SCORE) >= 0.5).cast("int"))
    area = ml.roc_auc(scored, "is_churned", monitor.SCORE)
    return ml.classification_metrics(judged, "is_churned", "prediction").select("*", area.scalar().alias("roc_auc"))


@R.add()
def split_shares(spark, folder):
    train, test = ml.stratified_split(_training(spark, folder), ["customer_id"])
    marked = train.select("is_churned", F.lit("train").alias("part")).unionByName(
        test.select("is_churned", F.lit("test").alias("part"))
    )
    return gold.counts_by(marked, ["part", "is_churned"])


@R.add(sql.query("rich", "SELECT is_churned, COUNT(*) AS total, TRUE AS fair_share, TRUE AS disjoint FROM churn GROUP BY 1", churn=_CHURN))
def split_totals(spark, folder):
    """The stratified split as SQL can see it: nobody lost or doubled, and about a fifth of each label to test on."""
    labelled = durable(ft.churn_label(catalog.enriched(spark, folder), catalog.AS_OF))
    train, test = ml.stratified_split(labelled, ["customer_id"])
    parts = train.withColumn("tested", F.lit(0)).unionByName(test.withColumn("tested", F.lit(1)))
    tested = F.sum("tested")
    # Six standard errors of a fifth: the split draws every customer by hash.
    fair = F.abs(tested - 0.2 * F.count("*")) <= 1 + 6 * F.sqrt(0.16 * F.count("*"))
    return parts.groupBy("is_churned").agg(
        F.count("*").alias("total"), fair.alias("fair_share"), (F.count("*") == F.count_distinct("customer_id")).alias("disjoint")
    )


@R.add()
def logistic_regression(spark, folder):
    train, test = ml.stratified_split(_training(spark, folder), ["customer_id"])
    scaling = ml.fit_zscore(train, _INPUTS)
    model = ml.logistic_regression(_INPUTS, "is_churned").fit(ml.zscore(train, scaling))
    return _evaluated(model, ml.zscore(test, scaling))


@R.add()
def random_forest(spark, folder):
    return _evaluated(*_fitted(ml.random_forest(_INPUTS, "is_churned"), spark, folder))


@R.add()
def gradient_boosting(spark, folder):
    return _evaluated(*_fitted(ml.gradient_boosting(_INPUTS, "is_churned"), spark, folder, weighted=True))


@R.add()
def cross_validation(spark, folder):
    train, _ = ml.stratified_split(_training(spark, folder), ["customer_id"])
    pipeline = ml.logistic_regression(_INPUTS, "is_churned")
    return ml.cross_validate(train, pipeline, "is_churned", ["customer_id"])[1]


@R.add()
def grid_search(spark, folder):
    train, _ = ml.stratified_split(_training(spark, folder), ["customer_id"])
    pipeline = ml.random_forest(_INPUTS, "is_churned")
    grid = {"numTrees": [50, 100], "maxDepth": [5, 10]}
    return ml.cross_validate(train, pipeline, "is_churned", ["customer_id"], grid, parallelism=4)[1]


@R.add()
def feature_importance(spark, folder):
    table = _training(spark, folder)
    forest, _ = _fitted(ml.random_forest(_INPUTS, "is_churned"), spark, folder, table=table)
    boosted, _ = _fitted(ml.gradient_boosting(_INPUTS, "is_churned"), spark, folder, weighted=True, table=table)
    return ml.average_importance([ml.importance(spark, m, _INPUTS) for m in (forest, boosted)], 10)


@R.add()
def scored_customers(spark, folder):
    table = _training(spark, folder)
    model, _ = _fitted(ml.logistic_regression(_INPUTS, "is_churned"), spark, folder, table=table)
    scored = ml.score(table, model)
    return scored.select("customer_id", monitor.SCORE, "churn_risk", "model_name", "model_stage")


@R.add(sql.query("rich", f"""SELECT customer_id, TRUE AS is_probability, TRUE AS risk_follows_score
    FROM (SELECT customer_id FROM ({_LIFE}))"""))
def scored_from_stored_model(spark, folder):
    """A model that is stored, loaded again and then scores every customer; what SQL can tell about the result."""
    path = scratch_dir(spark, "model")
    table = _training(spark, folder)
    model, _ = _fitted(ml.logistic_regression(_INPUTS, "is_churned"), spark, folder, table=table)
    ml.save(model, path)
    scored = ml.score(table, ml.load(path))
    risk = labels.score_risk(F.col(monitor.SCORE))
    return scored.select(
        "customer_id",
        F.col(monitor.SCORE).between(0, 1).alias("is_probability"),
        (F.col("churn_risk") == risk).alias("risk_follows_score"),
    )


def _load_velocity_rule():
    return lambda batch: (1.0 / (1.0 + 20.0 * batch["purchase_velocity"])).to_numpy()


@R.add(sql.query("rich", f"""SELECT customer_id, p AS churn_probability,
    CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk
    FROM (SELECT customer_id, round(1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE * purchase_velocity), 4) AS p FROM ({_LIFE}))"""))
def scored_with_udf(spark, folder):
    """A rule in plain Python, applied to Arrow batches on the executors."""
    life = ft.temporal(catalog.enriched(spark, folder), catalog.AS_OF)
    scored = ml.score_with_udf(life, ["purchase_velocity"], _load_velocity_rule)
    return scored.select("customer_id", monitor.SCORE, "churn_risk")


@R.add()
def embedding_classifier(spark, folder):
    """AUC of a linear model on the numbers of the embeddings, label below 5 against the rest. Shorter vectors end in 0."""
    rows = catalog.table(spark, folder, "embeddings")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    inputs = [f"x{i}" for i in range(width)]
    wide = rows.select(
        "vec_id",
        (F.col("label") < 5).cast("int").alias("low_label"),
        *[F.coalesce(F.get("embedding", F.lit(i)).cast("double"), F.lit(0.0)).alias(x) for i, x in enumerate(inputs)],
    )
    train, test = ml.stratified_split(wide, ["vec_id"])
    model = ml.logistic_regression(inputs, "low_label", penalty=0.01).fit(train)
    return ml.roc_auc(ml.score(test, model), "low_label", monitor.SCORE)
