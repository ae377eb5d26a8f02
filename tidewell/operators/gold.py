"""Business aggregates over enriched orders."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import labels
from tidewell.functions.numbers import MONEY, mean_money, percent, ratio
from tidewell.operators.ordered import global_ranks



def _completed(df: DataFrame) -> DataFrame:
    return df.where(F.col("order_status") == labels.COMPLETED)


def _total(name: str) -> Column:
    return F.sum(name).cast(MONEY)


def _having(status: str) -> Column:
    return F.count_if(F.col("order_status") == status)


def daily_revenue(enriched: DataFrame) -> DataFrame:
    """Completed orders per day: counts, gross and collected money, collection rate."""
    per_day = (
        _completed(enriched)
        .groupBy("order_date")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            _total("total_amount").alias("gross_revenue"),
            _total("payment_amount").alias("collected_revenue"),
            F.count("total_amount").alias("priced"),
            F.sum("quantity").alias("total_items_sold"),
        )
    )
    return daily_figures(per_day)


def daily_figures(per_day: DataFrame) -> DataFrame:
    """Average and collection rate from the counts and sums of each day."""
    return per_day.select(
        "order_date",
        "total_orders",
        "unique_customers",
        "gross_revenue",
        "collected_revenue",
        mean_money(F.col("gross_revenue"), F.col("priced")).alias("avg_order_value"),
        "total_items_sold",
        percent(F.col("collected_revenue"), F.col("gross_revenue")).alias("collection_rate"),
    )


def newest_first(df: DataFrame, column: str = "order_date") -> DataFrame:
    """Presentation order; not needed before a write."""
    return df.orderBy(F.desc_nulls_last(column))


def country_revenue(enriched: DataFrame, **rank_options: int) -> DataFrame:
    """Completed orders per country with revenue rank and percentile."""
    per_country = (
        _completed(enriched)
        .groupBy("customer_country")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("total_customers"),
            _total("total_amount").alias("total_revenue"),
            F.count("total_amount").alias("priced"),
            F.max("total_amount").alias("max_order_value"),
            F.min("total_amount").alias("min_order_value"),
        )
    )
    return country_figures(per_country, **rank_options)


def country_figures(per_country: DataFrame, **rank_options: int) -> DataFrame:
    """Average, rank and percentile from the counts and sums of each country."""
    return global_ranks(
        per_country.withColumn("avg_order_value", mean_money(F.col("total_revenue"), F.col("priced"))).drop("priced"),
        {"revenue_rank": "total_revenue"},
        {"revenue_percentile": "total_revenue"},
        **rank_options,
    )


def top_products(lines: DataFrame, **rank_options: int) -> DataFrame:
    """Completed order lines per product, ranked by revenue and by units."""
    per_product = (
        _completed(lines)
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("times_ordered"),
            F.count_distinct("customer_id").alias("unique_buyers"),
            F.sum("quantity").alias("total_units_sold"),
            _total("total_amount").alias("total_revenue"),
            F.sum("unit_price").alias("price_sum"),
            F.count("unit_price").alias("priced"),
        )
        .withColumn("avg_unit_price", mean_money(F.col("price_sum"), F.col("priced")))
        .drop("price_sum", "priced")
    )
    ranks = {"revenue_rank": "total_revenue", "units_rank": "total_units_sold"}
    return global_ranks(per_product, ranks, **rank_options)


def customer_360(enriched: DataFrame, as_of: datetime.date) -> DataFrame:
    """Lifetime metrics per customer with segment, recency and churn risk."""
    per_customer = enriched.groupBy("customer_id", "customer_name", "customer_email", "customer_country").agg(
        F.count("order_id").alias("total_orders"),
        _having(labels.COMPLETED).alias("completed_orders"),
        _having(labels.CANCELLED).alias("cancelled_orders"),
        _having(labels.PENDING).alias("pending_orders"),
        _total("total_amount").alias("total_spent"),
        F.count("total_amount").alias("priced"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.min("registration_date").alias("registered"),
    )
    return customer_figures(per_customer, as_of)


def customer_figures(per_customer: DataFrame, as_of: datetime.date) -> DataFrame:
    """Averages, segment, recency and risk from the counts and sums of each customer."""
    idle = F.datediff(F.lit(as_of), F.col("last_order_date"))
    return per_customer.withColumns(
        {
            "tenure_days": F.datediff(F.lit(as_of), F.col("registered")),
            "avg_order_value": mean_money(F.col("total_spent"), F.col("priced")),
            "completion_rate": percent(F.col("completed_orders"), F.col("total_orders")),
            "customer_segment": labels.segment(F.col("total_spent")),
            "days_since_last_order": idle,
            "churn_risk": labels.recency_risk(idle),
        }
    ).drop("priced", "registered")


def payment_metrics(enriched: DataFrame) -> DataFrame:
    """Completed payments per method: count, sum, average, extremes."""
    return (
        enriched.where(F.col("payment_status") == labels.COMPLETED)
        .groupBy("payment_method", "payment_category")
        .agg(
            F.count("payment_id").alias("total_transactions"),
            _total("payment_amount").alias("total_processed"),
            F.count("payment_amount").alias("known"),
            F.max("payment_amount").alias("max_transaction"),
            F.min("payment_amount").alias("min_transaction"),
        )
        .withColumn("avg_transaction", mean_money(F.col("total_processed"), F.col("known")))
        .drop("known")
    )


def payment_success(enriched: DataFrame) -> DataFrame:
    """Order money per payment method and the share of payments that completed."""
    per_method = (
        enriched.where(F.col("payment_method").isNotNull())
        .groupBy("payment_method")
        .agg(
            F.count("order_id").alias("transaction_count"),
            _total("total_amount").alias("total_processed"),
            F.count("total_amount").alias("priced"),
            F.count_if(F.col("payment_status") == labels.COMPLETED).alias("succeeded"),
        )
    )
    return per_method.select(
        "payment_method",
        "transaction_count",
        "total_processed",
        mean_money(F.col("total_processed"), F.col("priced")).alias("avg_transaction"),
        percent(F.col("succeeded"), F.col("transaction_count")).alias("success_rate_pct"),
    )


def executive_summary(
    enriched: DataFrame, lines: DataFrame | None = None, as_of: datetime.date | None = None
) -> DataFrame:
    """One row of overall figures over completed orders, from one pass over them.

    Countries and the whole are grouping sets of one aggregate, and so are products where ``enriched`` carries them;
    only group totals meet in the final task. ``lines`` adds the best-selling product of another table. ``as_of`` adds
    a ``report_date``.
    """
    done = _completed(enriched)
    own_products = lines is None and "product_id" in enriched.columns
    columns = ["customer_country", *(["product_id"] if own_products else [])]
    groups = done.groupingSets([*[[c] for c in columns], []], *columns).agg(
        _total("total_amount").alias("revenue"),
        F.count("order_id").alias("orders"),
        F.count("total_amount").alias("priced"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
        F.count_distinct("customer_id").alias("people"),
        F.grouping_id().alias("_set"),
    )
    everything = (1 << len(columns)) - 1
    of_all = lambda name: F.max(F.when(F.col("_set") == everything, F.col(name)))

    def best(name: str, kind: Column) -> Column:
        # Ties go to the smaller name: the greatest revenue first, then the least name.
        place = F.when(kind, F.struct((-F.col("revenue")).alias("r"), F.col(name).alias("n")))
        return F.min_by(F.when(kind, F.col(name)), place)

    # In a set's number a column that is not grouped by has its bit set, the first column the highest.
    sets = {c: F.col("_set") == everything - (1 << (len(columns) - 1 - i)) for i, c in enumerate(columns)}
    summary = groups.agg(
        of_all("revenue").alias("total_revenue"),
        F.coalesce(of_all("orders"), F.lit(0)).alias("total_orders"),
        of_all("priced").alias("priced"),
        of_all("first").alias("first_order_date"),
        of_all("last").alias("last_order_date"),
        best("customer_country", sets["customer_country"]).alias("top_country"),
        F.coalesce(of_all("people"), F.lit(0)).alias("total_customers"),
        *([best("product_id", sets["product_id"]).alias("top_product")] if own_products else []),
    ).withColumn("avg_order_value", mean_money(F.col("total_revenue"), F.col("priced")))
    shown = ["total_revenue", "total_orders", "avg_order_value", "first_order_date", "last_order_date", "top_country", "total_customers"]
    result = summary.select(*shown, *(["top_product"] if own_products else []))
    if lines is not None and "product_id" in lines.columns:
        per_product = _completed(lines).groupBy("product_id").agg(_total("total_amount").alias("revenue"))
        result = result.select("*", per_product.agg(best("product_id", F.lit(True)).alias("top_product")).scalar().alias("top_product"))
    return result if as_of is None else result.withColumn("report_date", F.lit(as_of))


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Total, row count and average (six places) of ``value`` per group."""
    stats = df.groupBy(group).agg(F.sum(value).alias("total"), F.count("*").alias("count"), F.count(value).alias("known"))
    return stats.withColumn("average", ratio(F.col("total"), F.col("known"), 6)).drop("known")


def counts_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of values, all in one pass."""
    return df.groupBy(*columns).agg(F.count("*").alias("count"))
