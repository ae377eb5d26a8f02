"""Cleaning: trimming, defaults, typed casts, case and e-mail flags, latest row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import looks_like_email, tidy
from tidewell.operators.ordered import all_columns_order
from tidewell.operators.ordered import latest_per_key as first_per_key


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: tidy(F.col(c)) for c in columns})


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a default of the column's own type."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in defaults.items()})


def _typed(df: DataFrame, kinds: Mapping[str, str], date_format: str) -> dict[str, Column]:
    kept = dict(df.dtypes)
    dates = lambda c: F.try_to_timestamp(F.col(c), F.lit(date_format)).cast("date")
    return {c: dates(c) if k == "date" and kept[c] == "string" else F.col(c).try_cast(k) for c, k in kinds.items()}


def cast_columns(df: DataFrame, kinds: Mapping[str, str], date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Typed columns; values that do not parse become NULL and are counted in ``_cast_errors``."""
    typed = _typed(df, kinds, date_format)
    lost = F.lit(0)
    for name, value in typed.items():
        lost = lost + F.when(F.col(name).isNotNull() & value.isNull(), 1).otherwise(0)
    return df.withColumns(typed | {"_cast_errors": lost})


def failed_casts(df: DataFrame, kinds: Mapping[str, str], date_format: str = "yyyy-MM-dd") -> Column:
    """The names of the columns whose value is there but does not parse, as an array."""
    typed = _typed(df, kinds, date_format)
    return F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)) for c, v in typed.items()]))


def normalise_case(df: DataFrame, cases: Mapping[str, str]) -> DataFrame:
    """Trim and bring columns to ``lower``, ``upper`` or ``title`` case."""
    return df.withColumns({c: tidy(F.col(c), case) for c, case in cases.items()})


def email_flag(df: DataFrame, column: str, flag: str = "is_valid_email") -> DataFrame:
    """True or false by the shape of the address; NULL stays NULL."""
    return df.withColumn(flag, looks_like_email(F.col(column)))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str = "_ingestion_timestamp", ties: Sequence[str] | None = None
) -> DataFrame:
    """The row with the greatest ``newest`` per key.

    Rows of one ingestion batch share their timestamp, so ties are broken by ``ties`` or, by
    default, by all other columns, which leaves only identical rows undecided.
    """
    if ties is None:
        rest = all_columns_order(df, skip=[*keys, newest])
    else:
        rest = [F.desc_nulls_last(c) for c in ties]
    return first_per_key(df, keys, [F.desc_nulls_last(newest), *rest])


def without_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
