"""Threshold and lookup labels. All sets below are fixed values of the business rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order status values, lower case everywhere.
COMPLETED, PENDING, CANCELLED, PROCESSING = "completed", "pending", "cancelled", "processing"
ORDER_STATUSES = (COMPLETED, PENDING, CANCELLED, PROCESSING)

# Lower bounds, inclusive.
AMOUNT_LEVELS = [(1000, "high"), (100, "medium")]
SEGMENTS = [(500, "Premium"), (200, "Regular"), (50, "Occasional")]
SCORE_RISKS = [(0.7, "HIGH"), (0.4, "MEDIUM")]
# Lower bounds, exclusive.
RECENCY_RISKS = [(30, "High"), (14, "Medium")]

PAYMENT_CATEGORIES = {
    "credit_card": "card",
    "debit_card": "card",
    "paypal": "digital_wallet",
    "bank_transfer": "bank",
}

# Change operations, long and short spelling.
OPERATION_CODES = {"INSERT": "I", "UPDATE": "U", "DELETE": "D"}
CHANGE_TYPES = {"I": "new_order", "U": "status_change", "D": "cancellation"}


def tier(value: Column, bounds: Iterable[tuple], default: str, strict: bool = False) -> Column:
    """Label of the first bound that ``value`` reaches (or exceeds, when ``strict``).

    ``bounds`` go from high to low. NULL reaches no bound and gets ``default``.
    """
    label = F.lit(default)
    for bound, name in sorted(bounds):
        reached = value > F.lit(bound) if strict else value >= F.lit(bound)
        label = F.when(reached, F.lit(name)).otherwise(label)
    return label


def lookup(value: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """``table[value]``, or ``default`` for values outside the table and for NULL."""
    branches = F.lit(default)
    for key, name in table.items():
        branches = F.when(value == F.lit(key), F.lit(name)).otherwise(branches)
    return branches


def segment(spent: Column) -> Column:
    return tier(spent, SEGMENTS, "New")


def recency_risk(days: Column) -> Column:
    return tier(days, RECENCY_RISKS, "Low", strict=True)


def score_risk(score: Column) -> Column:
    return tier(score, SCORE_RISKS, "LOW")


def payment_category(method: Column) -> Column:
    return lookup(F.lower(F.trim(method)), PAYMENT_CATEGORIES, "other")


def operation_code(operation: Column) -> Column:
    """``I``, ``U`` or ``D`` from either spelling; NULL for anything else."""
    spelled = F.upper(F.trim(operation))
    short = {code: code for code in OPERATION_CODES.values()}
    return lookup(spelled, OPERATION_CODES | short)
