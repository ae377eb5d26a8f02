"""Computed columns and the enriched order table."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import labels
from tidewell.functions.numbers import MONEY


def with_total(df: DataFrame, quantity: str = "quantity", price: str = "unit_price") -> DataFrame:
    """``total_amount``; an unknown quantity or price gives an unknown total."""
    return df.withColumn("total_amount", (F.col(quantity) * F.col(price)).cast(MONEY))


def with_payment_category(df: DataFrame, method: str = "payment_method") -> DataFrame:
    return df.withColumn("payment_category", labels.payment_category(F.col(method)))


def with_completed_flag(df: DataFrame, status: str = "order_status") -> DataFrame:
    """``is_completed``, false for an unknown status."""
    done = F.lower(F.trim(F.col(status))) == labels.COMPLETED
    return df.withColumn("is_completed", F.coalesce(done, F.lit(False)))


def bucket(
    df: DataFrame, column: str, bounds: Sequence[tuple], default: str, name: str, strict: bool = False
) -> DataFrame:
    """Threshold label of a numeric column."""
    return df.withColumn(name, labels.tier(F.col(column), bounds, default, strict))


def amount_level(df: DataFrame, column: str, name: str = "category") -> DataFrame:
    """``high`` above 1000, ``medium`` above 100, else ``low``."""
    return bucket(df, column, labels.AMOUNT_LEVELS, "low", name, strict=True)


def days_until(df: DataFrame, columns: Mapping[str, str], as_of: datetime.date) -> DataFrame:
    """New columns with the days from a date column to ``as_of``: ``{new name: date column}``."""
    return df.withColumns({name: F.datediff(F.lit(as_of), F.col(c)) for name, c in columns.items()})


def matching_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on shared key names."""
    return left.join(right, list(keys), "inner")


def payments_per_order(payments: DataFrame) -> DataFrame:
    """One row per order, so that joining payments never multiplies order amounts.

    The latest payment gives method, category, date and status; amounts are added up.
    """
    newest = F.struct("payment_date", "payment_id")
    last = F.max_by(F.struct("payment_id", "payment_method", "payment_category", "payment_date", "status"), newest)
    summed = payments.groupBy("order_id").agg(F.sum("amount").cast(MONEY).alias("amount"), last.alias("last"))
    return summed.select("order_id", "amount", "last.*")


def enriched_orders(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with its customer and its payments, where they exist.

    Payments come first: both sides are keyed by order, so no key is crowded. A customer with a
    large share of the orders is split by adaptive skew handling, which applies to the order side
    of a left join.
    """
    paid = payments.selectExpr(
        "order_id",
        "payment_id",
        "amount AS payment_amount",
        "payment_method",
        "payment_category",
        "payment_date",
        "status AS payment_status",
    )
    who = customers.selectExpr(
        "customer_id",
        "name AS customer_name",
        "email AS customer_email",
        "country AS customer_country",
        "registration_date",
    )
    placed = orders.withColumnRenamed("status", "order_status")
    return placed.join(paid, ["order_id"], "left").join(who, ["customer_id"], "left")
