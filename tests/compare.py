"""Order-insensitive comparison of query results."""

from __future__ import annotations

import datetime
from collections import Counter
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(result):
    columns, rows = result
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(actual, expected) -> str | None:
    """None when both ``(columns, rows)`` hold the same rows, else a short description."""
    if sorted(actual[0]) != sorted(expected[0]):
        return f"columns {sorted(actual[0])} != {sorted(expected[0])}"
    left, right = _rows(actual), _rows(expected)
    if left == right:
        return None
    extra, missing = left - right, right - left
    return f"{sum(extra.values())} extra {list(extra)[:2]}, {sum(missing.values())} missing {list(missing)[:2]}"
