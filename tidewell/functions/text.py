"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted e-mail shape.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def tidy(value: Column, case: str | None = None) -> Column:
    """Trimmed text, optionally in ``lower``, ``upper`` or ``title`` case."""
    shapers = {None: lambda c: c, "lower": F.lower, "upper": F.upper, "title": F.initcap}
    return shapers[case](F.trim(value))


def looks_like_email(value: Column) -> Column:
    return value.rlike(EMAIL_PATTERN)
