"""Money and ratio arithmetic that rounds half-up exactly, without binary floating point."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)


def money(value: Column) -> Column:
    """``decimal(18,2)``; text or numbers that do not fit become NULL."""
    return value.try_cast(MONEY)


# Operands of six decimals below 10^18 are divided as they are.
_EXACT = DecimalType(24, 6)


def _quotient(numerator: Column, denominator: Column, scale: int) -> Column:
    """``round(numerator / denominator * scale)`` of whole millionths, by an exact division of whole decimals."""
    whole = lambda x: (F.abs(x.try_cast(_EXACT)) * F.lit(10**6)).cast("decimal(25,0)")
    top, bottom = whole(numerator), F.nullif(whole(denominator), F.lit(0).cast("decimal(25,0)"))
    twice = (top * F.lit(2 * scale) + bottom).cast("decimal(38,0)")
    divisor = (bottom * F.lit(2)).cast("decimal(38,0)")
    return ((twice - twice % divisor) / divisor).cast("decimal(38,0)")


def _half_up(numerator: Column, denominator: Column, scale: int) -> Column:
    """``round(numerator / denominator * scale)`` as a whole decimal; NULL for a missing operand, a zero denominator or a
    quotient from about 10^17 on.

    Operands that are larger, or have more decimals, are moved by a common power of ten first, so that the greater one
    has twelve digits before the point.
    """
    double = lambda x: x.cast("double")
    exact = lambda x: double(x.try_cast(_EXACT)) == double(x)
    greater = F.greatest(F.abs(double(numerator)), F.abs(double(denominator)))
    power = F.pow(F.lit(10.0), F.lit(11) - F.floor(F.log10(greater)))
    moved = _quotient(double(numerator) * power, double(denominator) * power, scale)
    size = F.when(exact(numerator) & exact(denominator), _quotient(numerator, denominator, scale)).otherwise(moved)
    return F.when((numerator < 0) != (denominator < 0), -size).otherwise(size)


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """``numerator / denominator`` rounded half-up to ``places``, as double."""
    return _half_up(numerator, denominator, 10**places).cast("double") / float(10**places)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded half-up to two places, as double; NULL when ``whole`` is 0."""
    return _half_up(part, whole, 10_000).cast("double") / 100.0


def mean_money(total: Column, count: Column) -> Column:
    """Average of money amounts rounded half-up to cents, as ``decimal(18,2)``."""
    cents = _half_up(total, count, 100).try_cast("decimal(18,0)")
    return (cents * Decimal("0.01")).try_cast(MONEY)
