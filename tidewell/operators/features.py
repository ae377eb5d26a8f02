"""Customer features for churn models, and the churn label.

Input is the enriched order table: one row per order with ``customer_id``, ``order_status``,
``order_date``, ``total_amount``, ``quantity``, ``payment_method`` and ``registration_date``.
Products are read from the same table or from a separate table of order lines.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import labels
from tidewell.functions.numbers import MONEY, mean_money, percent, ratio
from tidewell.operators import quality
from tidewell.operators.clean import latest_per_key
from tidewell.sinks.tables import overwrite

KEY = "customer_id"
# The feature table's columns and the churn threshold.
RFM = ["recency_days", "frequency", "monetary_value", "avg_order_value", "max_order_value", "min_order_value"]
BEHAVIOUR = [
    "cancellation_rate",
    "pending_rate",
    "unique_products",
    "avg_basket_size",
    "total_items",
    "payment_methods_used",
]
LIFECYCLE = [
    "days_since_registration",
    "days_since_first_order",
    "days_since_last_order",
    "active_period_days",
    "purchase_velocity",
    "days_to_first_order",
]
FEATURES = [*RFM, *BEHAVIOUR, *LIFECYCLE]
LABEL = "is_churned"
# The label is a threshold on recency, so these features give it away.
LEAKY = ["recency_days", "days_since_last_order"]
CHURN_DAYS = 30
NO_RECENCY = 999


def _done() -> Column:
    return F.col("order_status") == labels.COMPLETED


def _when_done(value: str) -> Column:
    return F.when(_done(), F.col(value))


def _rfm_columns(today: Column) -> dict[str, Column]:
    """Recency, frequency and money from the aggregates of :func:`_rfm_aggregates`."""
    return {
        "recency_days": F.datediff(today, "done_last"),
        "frequency": F.col("done_orders"),
        "monetary_value": F.col("done_total"),
        "avg_order_value": mean_money(F.col("done_total"), F.col("done_priced")),
        "max_order_value": F.col("done_max"),
        "min_order_value": F.col("done_min"),
    }


def _rfm_aggregates() -> list[Column]:
    return [
        F.max(_when_done("order_date")).alias("done_last"),
        F.count(_when_done("order_id")).alias("done_orders"),
        F.sum(_when_done("total_amount")).cast(MONEY).alias("done_total"),
        F.count(_when_done("total_amount")).alias("done_priced"),
        F.max(_when_done("total_amount")).alias("done_max"),
        F.min(_when_done("total_amount")).alias("done_min"),
    ]


def rfm(enriched: DataFrame, as_of: datetime.date) -> DataFrame:
    """Recency, frequency and monetary features of customers with a completed order."""
    sums = enriched.where(_done()).groupBy(KEY).agg(*_rfm_aggregates())
    return sums.select(KEY, *[v.alias(n) for n, v in _rfm_columns(F.lit(as_of)).items()])


def behavioural(enriched: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Cancellation and pending rates, basket, product and payment-method variety.

    Everything but the product count comes from per (customer, method) sums, which also give the
    most frequent method (ties: the smaller name). Both branches end partitioned by customer, so
    joining them moves no rows.
    """
    joined = _with_variety(_per_customer(enriched), enriched if lines is None else lines)
    return joined.select(KEY, *[v.alias(n) for n, v in _behaviour_columns().items()], "preferred_payment_method")


def _per_customer(enriched: DataFrame, whole: bool = False) -> DataFrame:
    """Additive figures per customer in one pass: first per (customer, method), then per customer.

    ``whole`` adds the figures behind the RFM, lifecycle and label columns.
    """
    status = F.col("order_status")
    per_method = enriched.groupBy(KEY, "payment_method").agg(
        F.count("order_id").alias("orders"),
        F.count_if(status == labels.CANCELLED).alias("cancelled"),
        F.count_if(status == labels.PENDING).alias("pending"),
        F.sum("quantity").alias("items"),
        F.count("quantity").alias("baskets"),
        *(_rfm_aggregates() + _lifecycle_aggregates() if whole else []),
    )
    merged = {name: F.sum(name) for name in ("orders", "cancelled", "pending", "items", "baskets")}
    if whole:
        merged |= {name: F.sum(name) for name in ("done_orders", "done_priced", "all_orders")}
        merged |= {name: F.max(name) for name in ("done_last", "done_max", "last_order")}
        merged |= {name: F.min(name) for name in ("done_min", "registered", "first_order")}
        merged["done_total"] = F.sum("done_total").cast(MONEY)
    most_used = F.when(
        F.col("payment_method").isNotNull(), F.struct((-F.col("orders")).alias("n"), F.col("payment_method"))
    )
    return per_method.groupBy(KEY).agg(
        *[v.alias(n) for n, v in merged.items()],
        F.count("payment_method").alias("payment_methods_used"),
        F.min(most_used)["payment_method"].alias("preferred_payment_method"),
    )


def _with_variety(per_customer: DataFrame, bought: DataFrame) -> DataFrame:
    variety = bought.groupBy(KEY).agg(F.count_distinct("product_id").alias("unique_products"))
    return per_customer.join(variety, [KEY], "left")


def _behaviour_columns() -> dict[str, Column]:
    return {
        "cancellation_rate": percent(F.col("cancelled"), F.col("orders")),
        "pending_rate": percent(F.col("pending"), F.col("orders")),
        "unique_products": F.coalesce("unique_products", F.lit(0)),
        "avg_basket_size": ratio(F.col("items"), F.col("baskets")),
        "total_items": F.col("items"),
        "payment_methods_used": F.col("payment_methods_used"),
    }


def _lifecycle_columns(today: Column) -> dict[str, Column]:
    tenure = F.datediff(today, "registered")
    first, last = F.datediff(today, "first_order"), F.datediff(today, "last_order")
    return {
        "days_since_registration": tenure,
        "days_since_first_order": first,
        "days_since_last_order": last,
        "active_period_days": F.datediff("last_order", "first_order"),
        # Orders per started month of 30 days: n / (tenure / 30 + 1).
        "purchase_velocity": ratio(F.col("all_orders") * 30, tenure + 30, 3),
        "days_to_first_order": tenure - first,
    }


def _lifecycle_aggregates() -> list[Column]:
    return [
        F.min("registration_date").alias("registered"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.count("order_id").alias("all_orders"),
    ]


def temporal(enriched: DataFrame, as_of: datetime.date) -> DataFrame:
    """Tenure, first and last order, active period and purchase velocity over all orders."""
    sums = enriched.groupBy(KEY).agg(*_lifecycle_aggregates())
    return sums.select(KEY, *[v.alias(n) for n, v in _lifecycle_columns(F.lit(as_of)).items()])


def _churned(today: Column, days: int) -> Column:
    return (F.datediff(today, "done_last") > days).cast("int")


def churn_label(enriched: DataFrame, as_of: datetime.date, days: int = CHURN_DAYS) -> DataFrame:
    """1 when the last completed order is more than ``days`` days before ``as_of``."""
    last = enriched.where(_done()).groupBy(KEY).agg(F.max("order_date").alias("done_last"))
    return last.select(KEY, _churned(F.lit(as_of), days).alias(LABEL))


def customer_base(enriched: DataFrame) -> DataFrame:
    """One row per customer; conflicting names resolve to the latest order."""
    columns = [KEY, "customer_name", "customer_country"]
    picked = latest_per_key(enriched.select(*columns, "order_date", "order_id"), [KEY], "order_date", ["order_id"])
    return picked.select(*columns)


def _filled(features: DataFrame) -> DataFrame:
    """Defaults for customers without the orders a feature needs."""
    kinds = {f.name: f.dataType for f in features.schema.fields}
    defaults = dict.fromkeys(FEATURES, 0) | {"recency_days": NO_RECENCY, LABEL: 1}
    present = {c: v for c, v in defaults.items() if c in kinds}
    return features.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in present.items()})


def combine(
    base: DataFrame, rfm: DataFrame, behaviour: DataFrame, lifecycle: DataFrame, churn: DataFrame, drop_leaky: bool = False
) -> DataFrame:
    """Feature groups joined to the customers, gaps filled with defaults.

    Every group is aggregated by customer, so the joins reuse that partitioning.
    """
    groups = [rfm, behaviour.drop("preferred_payment_method"), lifecycle, churn]
    joined = base
    for group in groups:
        joined = joined.join(group, [KEY], "left")
    filled = _filled(joined)
    return filled.drop(*LEAKY) if drop_leaky else filled


def feature_table(
    enriched: DataFrame,
    as_of: datetime.date,
    lines: DataFrame | None = None,
    days: int = CHURN_DAYS,
    drop_leaky: bool = False,
) -> DataFrame:
    """Key, 18 features and label, the same values as :func:`combine` from one pass over the
    orders and one over the products."""
    today = F.lit(as_of)
    joined = _with_variety(_per_customer(enriched, whole=True), enriched if lines is None else lines)
    columns = _rfm_columns(today) | _behaviour_columns() | _lifecycle_columns(today)
    columns[LABEL] = _churned(today, days)
    kept = [c for c in FEATURES if not (drop_leaky and c in LEAKY)]
    return _filled(joined.select(KEY, *[columns[c].alias(c) for c in [*kept, LABEL]]))


# The rules a feature table should meet.
FEATURE_RULES = [
    {"column": "customer_id", "rule": "not_null"},
    {"column": "recency_days", "rule": "positive"},
    {"column": "frequency", "rule": "positive"},
    {"column": "monetary_value", "rule": "positive"},
    {"column": "cancellation_rate", "rule": "range", "min": 0, "max": 100},
]


def write_feature_table(df: DataFrame, path: str, keys: Sequence[str] = (KEY,)) -> None:
    """Write after proving that the key is complete and unique; raises otherwise."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    incomplete = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) > 0
    broken = groups.agg(
        F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(incomplete).alias("incomplete")
    ).first()
    if broken["repeated"] or broken["incomplete"]:
        raise quality.ExpectationError(
            f"feature key {list(keys)}: {broken['repeated']} repeated, {broken['incomplete']} incomplete"
        )
    overwrite(df, path)
