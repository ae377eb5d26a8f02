"""The layered job: raw files to bronze, silver and gold tables on Parquet.

Each table is a plain function of its inputs; :func:`run` chains them through storage, so that
every layer is computed once and the next one reads it back.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import sinks, sources
from tidewell.functions import labels
from tidewell.operators import clean, enrich, features, gold, quality

# Raw schemas. Identifiers must be present; file readers do not enforce that, so it is a rule.
RAW_ORDERS = (
    "order_id string, customer_id string, product_id string, quantity int, unit_price double, order_date string, status string"
)
RAW_CUSTOMERS = (
    "customer_id string, name string, email string, country string, registration_date string"
)
RAW_PAYMENTS = (
    "payment_id string, order_id string, amount double, payment_method string, payment_date string, status string"
)
READERS = {
    "orders": (sources.read_csv, RAW_ORDERS, {}),
    "customers": (sources.read_csv, RAW_CUSTOMERS, {}),
    "payments": (sources.read_json, RAW_PAYMENTS, {"multi_line": True}),
}
# What an order needs to leave quarantine.
ORDER_RULES: dict[str, str | Column] = {
    "valid_total": "total_amount > 0",
    "valid_customer": "customer_id IS NOT NULL",
    "valid_status": f"order_status IN {(labels.COMPLETED, labels.PENDING, labels.CANCELLED)}",
}
MONEY_SQL = "decimal(18,2)"
KEYS = {"orders": "order_id", "customers": "customer_id", "payments": "payment_id"}
CASTS = {
    "orders": {"quantity": "int", "unit_price": MONEY_SQL, "order_date": "date"},
    "customers": {"registration_date": "date"},
    "payments": {"amount": MONEY_SQL, "payment_date": "date"},
}


def bronze(spark: SparkSession, name: str, path: str, batch_id: str = "manual") -> DataFrame:
    reader, schema, options = READERS[name]
    return sources.with_audit(reader(spark, path, schema, **options), batch_id)


def _present(raw: DataFrame, key: str) -> DataFrame:
    return raw.where(F.col(key).isNotNull())


def _latest(df: DataFrame, key: str) -> DataFrame:
    return clean.latest_per_key(df.drop("_cast_errors", "_corrupt_record"), [key])


def rejects(name: str, raw: DataFrame) -> DataFrame:
    """What bronze rows lose on their way to silver, with the reasons: rows without a key, which silver does not have,
    and records or values that did not parse, which it has as NULL."""
    key, text = KEYS[name], [c for c in raw.columns if not c.startswith("_")]
    bad = F.transform(clean.failed_casts(raw, CASTS[name]), lambda c: F.concat(F.lit("bad "), c))
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in raw.columns else F.lit(False)
    marks = F.array_compact(F.array(F.when(F.col(key).isNull(), F.lit(f"no {key}")), F.when(corrupt, F.lit("corrupt record"))))
    audit = [c for c in raw.columns if c.startswith("_") and c != "_corrupt_record"]
    shown = F.to_json(F.struct(*[F.col(c) for c in text]))
    judged = raw.select(F.lit(name).alias("source"), F.col(key).alias("record_key"), F.concat(marks, bad).alias("reasons"), shown.alias("record"), *audit)
    return judged.where(F.size("reasons") > 0)


def silver_orders(raw: DataFrame) -> DataFrame:
    """Typed orders, one row per id. The total comes before the defaults: unknown stays unknown."""
    tidy = clean.normalise_case(
        _present(raw, "order_id"), {"order_id": None, "customer_id": None, "product_id": None, "status": "lower"}
    )
    typed = clean.cast_columns(tidy, CASTS["orders"])
    filled = clean.fill_defaults(enrich.with_total(typed), {"quantity": 1, "unit_price": 0, "status": "unknown"})
    return _latest(filled, "order_id")


def silver_customers(raw: DataFrame) -> DataFrame:
    tidy = clean.normalise_case(
        _present(raw, "customer_id"), {"customer_id": None, "name": "title", "email": "lower", "country": "title"}
    )
    typed = clean.cast_columns(tidy, CASTS["customers"])
    return _latest(clean.email_flag(typed, "email"), "customer_id")


def silver_payments(raw: DataFrame) -> DataFrame:
    tidy = clean.normalise_case(
        _present(raw, "payment_id"),
        {"payment_id": None, "order_id": None, "payment_method": "lower", "status": "lower"},
    )
    typed = clean.cast_columns(tidy, CASTS["payments"])
    return _latest(enrich.with_payment_category(typed), "payment_id")


SILVER = {"orders": silver_orders, "customers": silver_customers, "payments": silver_payments}


def enriched(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Enriched orders at order grain: several payments of an order count as one sum."""
    audit = ["_ingestion_timestamp", "_source_file", "_batch_id"]
    paid = enrich.payments_per_order(payments)
    return enrich.with_completed_flag(enrich.enriched_orders(orders.drop(*audit), customers, paid))


def gold_tables(orders: DataFrame, as_of: datetime.date) -> Mapping[str, DataFrame]:
    """All gold tables from valid enriched orders."""
    return {
        "daily_revenue": gold.daily_revenue(orders),
        "country_revenue": gold.country_revenue(orders),
        "top_products": gold.top_products(orders),
        "customer_360": gold.customer_360(orders, as_of),
        "payment_metrics": gold.payment_metrics(orders),
        "payment_success": gold.payment_success(orders),
        "executive_summary": gold.executive_summary(orders, as_of=as_of),
        "customer_features": features.feature_table(orders, as_of),
    }


def run(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    root: str,
    as_of: datetime.date,
    batch_id: str = "manual",
) -> list[str]:
    """Run every layer below ``root`` and return the table paths.

    Bronze appends; silver is rebuilt from all of bronze, with a table of what it lost; gold is rebuilt from silver.
    :mod:`tidewell.plans.layers` does the same from new files only.
    """
    written: list[str] = []

    def place(layer: str, name: str) -> str:
        written.append(f"{root}/{layer}/{name}")
        return written[-1]

    silver: dict[str, DataFrame] = {}
    for name, path in raw_paths.items():
        landed = place("bronze", name)
        sinks.append(bronze(spark, name, path, batch_id), landed)
        kept, raw = place("silver", name), sources.read_parquet(spark, landed, merge_schema=True)
        sinks.overwrite(SILVER[name](raw), kept)
        sinks.overwrite(rejects(name, raw), place("silver", f"{name}_rejects"))
        silver[name] = sources.read_parquet(spark, kept)

    everything = place("silver", "enriched_orders")
    joined = enriched(silver["orders"], silver["customers"], silver["payments"])
    sinks.overwrite_partitions(joined, everything, ["order_date"])
    stored = sources.read_parquet(spark, everything)
    valid, quarantined = quality.split(stored, ORDER_RULES)
    sinks.overwrite(quarantined, place("silver", "quarantine"))
    trusted = place("silver", "validated_orders")
    sinks.overwrite_partitions(valid, trusted, ["order_date"])
    for name, table in gold_tables(sources.read_parquet(spark, trusted), as_of).items():
        sinks.overwrite(table, place("gold", name))
    return written
