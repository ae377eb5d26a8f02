"""Business aggregates and data-quality reports."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidewell import catalog
from tidewell.functions import labels
from tidewell.operators import enrich, gold, ordered, quality
from tidewell.operators.ordered import global_ranks
from tidewell.plans import layers, sql
from tidewell.plans.registry import Registry
from tidewell.session import durable, scratch_dir, stored
from tidewell.sinks.versions import VersionedTable, replaced
from tidewell.streaming import views
from tidewell.streaming.rules import RuleState

R = Registry()

# --- aggregates -------------------------------------------------------------------------------

_DAILY = f"""SELECT order_date, COUNT(order_id) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers,
        {sql.total('total_amount')} AS gross, {sql.total('payment_amount')} AS collected,
        COUNT(total_amount) AS priced, {sql.big('SUM(quantity)')} AS total_items_sold
    FROM rich WHERE order_status = 'completed' GROUP BY 1"""


_DAILY_SQL = sql.query(
    "rich",
    f"""SELECT order_date, total_orders, unique_customers, {sql.dbl('gross')} AS gross_revenue,
    {sql.dbl('collected')} AS collected_revenue, {sql.mean_money('gross', 'priced')} AS avg_order_value,
    total_items_sold, {sql.percent_money('collected', 'gross')} AS collection_rate FROM d""",
    d=_DAILY,
)


@R.add(_DAILY_SQL)
def daily_revenue(spark, folder):
    return gold.newest_first(gold.daily_revenue(catalog.enriched(spark, folder)))


_COUNTRY = f"""SELECT customer_country, COUNT(order_id) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers,
        {sql.total('total_amount')} AS total_revenue, COUNT(total_amount) AS priced,
        MAX(total_amount) AS max_order_value, MIN(total_amount) AS min_order_value
    FROM rich WHERE order_status = 'completed' GROUP BY 1"""
_COUNTRY_RANKED = """SELECT *, dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank,
        rank() OVER (ORDER BY total_revenue DESC NULLS LAST) - 1 AS above, COUNT(*) OVER () - 1 AS others FROM c"""
_COUNTRY_SQL = sql.query(
    "rich",
    f"""SELECT customer_country, total_orders, total_customers, {sql.dbl('total_revenue')} AS total_revenue,
    {sql.dbl('max_order_value')} AS max_order_value, {sql.dbl('min_order_value')} AS min_order_value,
    {sql.mean_money('total_revenue', 'priced')} AS avg_order_value, CAST(revenue_rank AS INT) AS revenue_rank,
    COALESCE({sql.percent('above', 'others')}, 0.0) AS revenue_percentile FROM r""",
    c=_COUNTRY,
    r=_COUNTRY_RANKED,
)


@R.add(_COUNTRY_SQL)
def country_revenue(spark, folder):
    return gold.country_revenue(catalog.enriched(spark, folder))


_PRODUCT = f"""SELECT product_id, COUNT(order_id) AS times_ordered, COUNT(DISTINCT customer_id) AS unique_buyers,
        {sql.big('SUM(quantity)')} AS total_units_sold, {sql.total('total_amount')} AS total_revenue,
        {sql.big('SUM(unit_cents)')} AS cents, COUNT(unit_cents) AS priced
    FROM lines WHERE order_status = 'completed' GROUP BY 1"""
_PRODUCT_SQL = sql.query(
    "lines",
    f"""SELECT product_id, times_ordered, unique_buyers, total_units_sold, {sql.dbl('total_revenue')} AS total_revenue,
    {sql.dbl('(cents * 2 + priced) // (2 * priced)')} / 100.0 AS avg_unit_price,
    CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INT) AS revenue_rank,
    CAST(dense_rank() OVER (ORDER BY total_units_sold DESC NULLS LAST) AS INT) AS units_rank FROM p""",
    p=_PRODUCT,
)


@R.add(_PRODUCT_SQL)
def top_products(spark, folder):
    return gold.top_products(catalog.order_lines(spark, folder))


@R.add(_PRODUCT_SQL)
def top_products_in_slots(spark, folder):
    """The same ranks by the route for tables too large for one ordered task."""
    return gold.top_products(catalog.order_lines(spark, folder), one_task_rows=0, slots=16)


@R.add(sql.query("placed", f"""SELECT customer_id, {sql.dbl('spent')} AS spent, CAST(spent_rank AS INT) AS spent_rank,
    COALESCE({sql.percent('above', 'others')}, 0.0) AS spent_percentile FROM r""",
    s=f"SELECT customer_id, {sql.total('total_amount')} AS spent FROM placed GROUP BY 1",
    r="""SELECT *, dense_rank() OVER (ORDER BY spent DESC NULLS LAST) AS spent_rank,
        rank() OVER (ORDER BY spent DESC NULLS LAST) - 1 AS above, COUNT(*) OVER () - 1 AS others FROM s"""))
def customer_percentiles(spark, folder):
    spent = catalog.orders(spark, folder).groupBy("customer_id").agg(F.sum("total_amount").alias("spent"))
    return global_ranks(spent, {"spent_rank": "spent"}, {"spent_percentile": "spent"}, one_task_rows=0, slots=16)


_C360 = f"""SELECT customer_id, customer_name, customer_email, customer_country, COUNT(order_id) AS total_orders,
        COUNT(*) FILTER (order_status = 'completed') AS completed_orders,
        COUNT(*) FILTER (order_status = 'cancelled') AS cancelled_orders,
        COUNT(*) FILTER (order_status = 'pending') AS pending_orders,
        {sql.total('total_amount')} AS spent, COUNT(total_amount) AS priced,
        MAX(order_date) AS last_order_date, MIN(order_date) AS first_order_date,
        CAST(MAX(DATE '2001-08-02' - registration_date) AS INT) AS tenure_days
    FROM rich GROUP BY ALL"""


_C360_SQL = sql.query(
    "rich",
    f"""SELECT customer_id, customer_name, customer_email, customer_country, total_orders,
    completed_orders, cancelled_orders, pending_orders, {sql.dbl('spent')} AS total_spent, last_order_date,
    first_order_date, tenure_days, {sql.mean_money('spent', 'priced')} AS avg_order_value,
    {sql.percent('completed_orders', 'total_orders')} AS completion_rate,
    CASE WHEN spent >= 500 THEN 'Premium' WHEN spent >= 200 THEN 'Regular' WHEN spent >= 50 THEN 'Occasional'
         ELSE 'New' END AS customer_segment,
    CAST(DATE '2001-08-02' - last_order_date AS INT) AS days_since_last_order,
    CASE WHEN DATE '2001-08-02' - last_order_date > 30 THEN 'High'
         WHEN DATE '2001-08-02' - last_order_date > 14 THEN 'Medium' ELSE 'Low' END AS churn_risk FROM c""",
    c=_C360,
)


@R.add(_C360_SQL)
def customer_360(spark, folder):
    return gold.customer_360(catalog.enriched(spark, folder), catalog.AS_OF)


# --- views kept from changes ------------------------------------------------------------------

# Ends of the batches in which the life of the orders arrives.
BATCH_ENDS = [datetime.date(1996, 1, 1), datetime.date(1999, 1, 1), datetime.date(2100, 1, 1)]


def _order_events(spark, folder):
    """Every order arrives as pending with its stated price; 30 days later it is completed with the sum of its lines,
    goes if it was cancelled, or stays as it is but for the price."""
    stated = catalog.table(spark, folder, "orders").selectExpr("o_orderkey AS order_id", "CAST(o_totalprice AS DECIMAL(18,2)) AS stated")
    orders = catalog.orders(spark, folder).join(stated, ["order_id"])
    first = F.struct(
        F.col("order_date").alias("on"), F.lit(labels.PENDING).alias("status"), F.lit(1).cast("long").alias("quantity"),
        F.col("stated").alias("total_amount"), F.lit(False).alias("gone"),
    )
    then = F.struct(
        F.date_add("order_date", 30).alias("on"), "status", "quantity", "total_amount",
        (F.col("status") == labels.CANCELLED).alias("gone"),
    )
    return orders.select("order_id", "customer_id", "order_date", F.explode(F.array(first, then)).alias("e")).select(
        "order_id", "customer_id", "order_date", "e.*"
    )


def _kept_view(spark, folder, view):
    """A view after three batches of inserts, updates and deletes."""
    place, events = scratch_dir(spark, view.name), durable(_order_events(spark, folder))
    customers, payments = catalog.customers(spark, folder), catalog.payments(spark, folder)
    table = VersionedTable(spark, f"{place}/orders", ["order_id"], 8)
    begin, now = datetime.date(1970, 1, 1), datetime.datetime(2024, 2, 1)
    for end in BATCH_ENDS:
        batch = events.where((F.col("on") >= F.lit(begin)) & (F.col("on") < F.lit(end)))
        latest = ordered.latest_per_key(batch, ["order_id"], [F.desc("on")]).drop("on")
        version = table.commit(latest, replaced(["order_id"], "gone"), now)
        feed = enrich.enriched_orders(table.changes(version, version), customers, payments)
        views.refresh(place, view, feed, now, number=version, buckets=8)
        begin = end
    return views.read(spark, place, view, 8)


def _incremental_sql(full: str) -> str:
    """The full rebuild over the orders that are left."""
    return full.replace("FROM rich", "FROM (SELECT * FROM rich WHERE order_status <> 'cancelled')")


@R.add(_DAILY_SQL)
def daily_revenue_incremental(spark, folder):
    return views.daily_revenue(_kept_view(spark, folder, views.DAILY))


@R.add(_COUNTRY_SQL)
def country_revenue_incremental(spark, folder):
    return views.country_revenue(_kept_view(spark, folder, views.COUNTRY))


@R.add(_incremental_sql(_C360_SQL))
def customer_360_incremental(spark, folder):
    return views.customer_360(_kept_view(spark, folder, views.CUSTOMER), catalog.AS_OF)


@R.add(_DAILY_SQL.replace(sql.big("SUM(quantity)"), "COUNT(order_id)"))
def layered_daily_revenue(spark, folder):
    """Raw files of two deliveries through all layers: the second one changes all orders that the first one brought."""
    root = scratch_dir(spark, "layers")
    # Written once: each delivery takes its rows.
    orders = stored(_order_events(spark, folder).where("NOT gone").selectExpr(
        "order_id", "customer_id", "'p1' AS product_id", "1 AS quantity", "total_amount AS unit_price", "order_date", "status", "on = order_date AS early"
    ))
    customers, payments = catalog.customers(spark, folder), catalog.payments(spark, folder).drop("payment_category")
    raw = {name: f"{root}/raw/{name}" for name in layers.KINDS}
    columns, text = ["customer_id", "name", "email", "country", "registration_date"], {"header": True, "compression": "gzip"}
    for delivery in (True, False):
        orders.where(F.col("early") == delivery).drop("early").write.mode("append").options(**text).csv(raw["orders"])
        if delivery:
            customers.select(columns).write.options(**text).csv(raw["customers"])
        payments.where((F.col("status") == labels.COMPLETED) == delivery).write.mode("append").options(**text).json(raw["payments"])
        made = layers.run(spark, raw, f"{root}/lake", buckets=8)
    return made.gold(catalog.AS_OF)["daily_revenue"]


# --- payments and summary ---------------------------------------------------------------------


@R.add(sql.query("rich", f"""SELECT payment_method, payment_category, n AS total_transactions, {sql.dbl('t')} AS total_processed,
    {sql.dbl('hi')} AS max_transaction, {sql.dbl('lo')} AS min_transaction, {sql.mean_money('t', 'n')} AS avg_transaction
    FROM m""", m=f"""SELECT payment_method, payment_category, COUNT(payment_id) AS n, {sql.total('payment_amount')} AS t,
        MAX(payment_amount) AS hi, MIN(payment_amount) AS lo
    FROM rich WHERE payment_status = 'completed' GROUP BY ALL"""))
def payment_metrics(spark, folder):
    return gold.payment_metrics(catalog.enriched(spark, folder))


@R.add(sql.query("rich", f"""SELECT payment_method, n AS transaction_count, {sql.dbl('t')} AS total_processed,
    {sql.mean_money('t', 'n')} AS avg_transaction, {sql.percent('done', 'n')} AS success_rate_pct
    FROM m""", m=f"""SELECT payment_method, COUNT(order_id) AS n, {sql.total('total_amount')} AS t,
        COUNT(*) FILTER (payment_status = 'completed') AS done
    FROM rich WHERE payment_method IS NOT NULL GROUP BY 1"""))
def payment_success(spark, folder):
    return gold.payment_success(catalog.enriched(spark, folder))


@R.add(sql.query("rich lines", f"""SELECT {sql.dbl(sql.total('total_amount'))} AS total_revenue, COUNT(order_id) AS total_orders,
    {sql.mean_money(sql.total('total_amount'), 'COUNT(total_amount)')} AS avg_order_value,
    MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
    (SELECT customer_country FROM rich WHERE order_status = 'completed' GROUP BY 1
        ORDER BY SUM(total_amount) DESC, customer_country LIMIT 1) AS top_country,
    COUNT(DISTINCT customer_id) AS total_customers,
    (SELECT product_id FROM lines WHERE order_status = 'completed' GROUP BY 1
        ORDER BY SUM(total_amount) DESC, product_id LIMIT 1) AS top_product
    FROM rich WHERE order_status = 'completed'"""))
def executive_summary(spark, folder):
    return gold.executive_summary(catalog.enriched(spark, folder), catalog.order_lines(spark, folder))


@R.add(f"""SELECT event_type, {sql.dbl('t')} AS total, n AS count, {sql.ratio('CAST(t * 100 AS HUGEINT)', 'n * 100', 6)}
    AS average FROM (SELECT event_type, CAST(SUM(CAST(value AS {sql.MONEY})) AS {sql.MONEY}) AS t, COUNT(*) AS n
    FROM events GROUP BY 1)""")
def group_stats(spark, folder):
    amounts = catalog.changes(spark, folder).select(F.col("status").alias("event_type"), "balance")
    return gold.group_stats(amounts, "event_type", "balance")


@R.add(sql.query("heads", "SELECT status, COUNT(*) AS count FROM heads GROUP BY 1"))
def counts_by_status(spark, folder):
    heads = catalog.table(spark, folder, "orders").select(labels.lookup(F.col("o_orderstatus"), catalog.STATUS).alias("status"))
    return gold.counts_by(heads, ["status"])


# --- quality ----------------------------------------------------------------------------------


def _rules(spark, folder):
    return (
        quality.not_null("order_id", "customer_id", "payment_id")
        + quality.unique("order_id", "customer_id")
        + quality.positive("quantity", "total_amount")
        + quality.in_set("order_status", ["completed", "pending"])
        + quality.between("quantity", 1, 100)
        + quality.email("customer_email")
        + quality.length("customer_name", 5, 18, level=quality.INFO)
        + quality.matches("customer_country", "_1")
        + quality.references("payment_id", catalog.payments(spark, folder), "payment_id", level=quality.WARNING)
    )


def _rule_sql(kind: str, column: str, level: str, bad: str, complaint: str) -> str:
    return f"""SELECT '{kind}' AS rule_name, '{column}' AS "column", '{level}' AS level, COUNT(*) AS total_records,
        CAST({bad} AS BIGINT) AS failed_records, '{complaint}' AS complaint FROM rich"""


def _failing(condition: str) -> str:
    return f"COUNT(*) FILTER ({condition})"


_RULES = " UNION ALL ".join(
    [
        *[
            _rule_sql("not_null", c, "error", _failing(f"{c} IS NULL"), "null values")
            for c in ("order_id", "customer_id", "payment_id")
        ],
        *[
            _rule_sql("unique", c, "error", f"COUNT(*) - COUNT(DISTINCT {c})", "duplicate values")
            for c in ("order_id", "customer_id")
        ],
        *[
            _rule_sql("positive", c, "error", _failing(f"{c} <= 0"), "non-positive values")
            for c in ("quantity", "total_amount")
        ],
        _rule_sql("in_set", "order_status", "error", _failing("order_status NOT IN ('completed', 'pending')"),
                  "values not in allowed set"),
        _rule_sql("range", "quantity", "error", _failing("quantity < 1 OR quantity > 100"), "values outside range"),
        _rule_sql("regex", "customer_email", "warning",
                  _failing(r"NOT regexp_matches(customer_email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"),
                  "values not matching pattern"),
        _rule_sql("length", "customer_name", "info", _failing("length(customer_name) < 5 OR length(customer_name) > 18"),
                  "values with invalid length"),
        _rule_sql("regex", "customer_country", "warning", _failing("NOT regexp_matches(customer_country, '_1')"),
                  "values not matching pattern"),
        _rule_sql("referential_integrity", "payment_id", "warning",
                  _failing("payment_id IS NULL OR payment_id NOT IN (SELECT payment_id FROM paid)"), "orphan records"),
    ]
)
_RESULTS = f"""SELECT rule_name, "column", level, failed_records = 0 AS passed, total_records, failed_records,
    {sql.percent('failed_records', 'total_records')} AS failure_rate,
    'Column ''' || "column" || ''' has ' || failed_records || ' ' || complaint AS message FROM rules"""


@R.add(sql.query("rich", _RESULTS, rules=_RULES))
def rule_results(spark, folder):
    return quality.validate(catalog.enriched(spark, folder), _rules(spark, folder), once=True)


@R.add(sql.query("rich", f"""SELECT COUNT(*) AS total_rules, COUNT(*) FILTER (passed) AS passed_rules,
    COUNT(*) FILTER (NOT passed) AS failed_rules, COUNT(*) FILTER (NOT passed AND level = 'error') AS errors,
    COUNT(*) FILTER (NOT passed AND level = 'warning') AS warnings,
    {sql.percent('COUNT(*) FILTER (passed)', 'COUNT(*)')} AS pass_rate,
    CASE WHEN COUNT(*) FILTER (NOT passed AND level = 'error') > 0 THEN 'FAILED' ELSE 'PASSED' END AS status
    FROM results""", rules=_RULES, results=_RESULTS))
def rule_summary(spark, folder):
    return quality.summary(quality.validate(catalog.enriched(spark, folder), _rules(spark, folder), once=True))


@R.add(sql.query("rich", """SELECT rule_name, "column", failed_records FROM rules
    WHERE failed_records > total_records * 0.05::DOUBLE""", rules=_RULES))
def rule_alerts(spark, folder):
    results = quality.validate(catalog.enriched(spark, folder), _rules(spark, folder), once=True)
    return quality.alerts(results).select("rule_name", "column", "failed_records")


@R.add(sql.query("rich", _RESULTS, rules=_RULES))
def incremental_rules(spark, folder):
    """The rules after three batches of orders; countries and customers arrive in two parts, the second one last."""
    given = _rules(spark, folder)
    state = RuleState(spark, scratch_dir(spark, "rules"), given, buckets=8)
    rich, now = durable(catalog.enriched(spark, folder)), datetime.datetime(2024, 2, 1)
    references = {r.option("key"): r.option("table") for r in given if r.kind == "referential_integrity"}

    def keys(name, number):
        table = references[name]
        part = F.pmod(F.hash(name), F.lit(2)) == number
        state.add_keys(name, table.select(name).where(part), number, now)

    for name in references:
        keys(name, 0)
    begin = datetime.date(1970, 1, 1)
    for number, end in enumerate(BATCH_ENDS):
        state.add(rich.where((F.col("order_date") >= F.lit(begin)) & (F.col("order_date") < F.lit(end))), number, now)
        begin = end
    for name in references:
        keys(name, 1)
    return state.results()


_EXPECTED = {
    "valid_total": "total_amount > 100000",
    "paid": "payment_id IS NOT NULL",
    "valid_status": "order_status IN ('completed', 'pending')",
}


@R.add(sql.query("rich", " UNION ALL ".join(
    f"""SELECT '{name}' AS expectation, COUNT(*) FILTER ({p}) AS passed_records,
        COUNT(*) - COUNT(*) FILTER ({p}) AS failed_records FROM rich""" for name, p in _EXPECTED.items())))
def expectation_counts(spark, folder):
    return quality.expect(catalog.enriched(spark, folder), _EXPECTED, "warn")[1]


_ALL_HOLD = " AND ".join(f"COALESCE({p}, FALSE)" for p in _EXPECTED.values())


@R.add(sql.query("rich", f"""SELECT order_id, customer_id, {sql.dbl('total_amount')} AS total_amount, order_status
    FROM rich WHERE {_ALL_HOLD}"""))
def valid_orders(spark, folder):
    valid, _ = quality.split(catalog.enriched(spark, folder), _EXPECTED)
    return valid.select("order_id", "customer_id", "total_amount", "order_status")


@R.add(sql.query("rich", f"""SELECT order_id, customer_id, {sql.dbl('total_amount')} AS total_amount, order_status,
    array_to_string(list_filter([{", ".join(f"CASE WHEN NOT COALESCE({p}, FALSE) THEN '{n}' END" for n, p in _EXPECTED.items())}],
        lambda r: r IS NOT NULL), ',') AS reasons FROM rich WHERE NOT ({_ALL_HOLD})"""))
def quarantined_orders(spark, folder):
    _, quarantined = quality.split(catalog.enriched(spark, folder), _EXPECTED)
    return quarantined.select("order_id", "customer_id", "total_amount", "order_status", F.array_join("reasons", ",").alias("reasons"))


@R.add(sql.query("rich", f"SELECT order_status, COUNT(*) AS orders FROM rich WHERE {_ALL_HOLD} GROUP BY 1"))
def expect_or_drop(spark, folder):
    kept, _ = quality.expect(catalog.enriched(spark, folder), _EXPECTED, "drop")
    return kept.groupBy("order_status").agg(F.count("*").alias("orders"))


@R.add(sql.query("paid", f"""SELECT order_id, {sql.dbl(sql.total('amount'))} AS amount,
    arg_max(payment_method, (payment_date, payment_id)) AS payment_method FROM paid GROUP BY 1"""))
def payments_per_order(spark, folder):
    return enrich.payments_per_order(catalog.payments(spark, folder)).select("order_id", "amount", "payment_method")
