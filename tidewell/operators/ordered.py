"""Order-dependent work without one-task windows: latest rows, cut points, and ranks over a whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from tidewell.functions.numbers import percent
from tidewell.operators import scan
from tidewell.session import stored

# Rows of a key beyond which its history comes from an ordered scan.
SPLIT_ROWS = 2_000_000


def range_bucket(value: Column, cuts: Sequence) -> Column:
    """Number of sorted ``cuts`` that are at or below ``value``; 0 for NULL.

    Built as a binary search, so a row passes ``log2(len(cuts))`` comparisons.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(cuts[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(cuts))


def quantile_cuts(df: DataFrame, columns: Mapping[str, Column], parts: int) -> dict[str, list]:
    """Points that cut numeric columns into ``parts`` of about equal row counts, in one aggregate.

    NULLs are skipped; a column without values has no cuts.
    """
    shares = [i / parts for i in range(1, parts)]
    if not shares or not columns:
        return {name: [] for name in columns}
    found = df.agg(*[F.percentile_approx(c, shares, 4 * parts).alias(n) for n, c in columns.items()]).first()
    return {name: sorted(set(found[name] or [])) for name in columns}


def number_line(df: DataFrame, name: str) -> Column:
    """A number, date or timestamp column as a double."""
    kind = df.schema[name].dataType
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        raise TypeError(f"{name} is text; a number, date or timestamp is needed")
    return F.col(name).cast("double")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should end in tie-breakers.

    The ``row_number() = 1`` filter is pushed below the shuffle as a group limit, so each map task
    sends at most one row per key and a crowded key does not gather in one task.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def all_columns_order(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """Descending order over every column: a total order up to identical rows."""
    return [F.desc_nulls_last(c) for c in df.columns if c not in skip]


def _small_ranks(base: DataFrame, ranks: Mapping[str, str], percents: Mapping[str, str]) -> DataFrame:
    everything = W.partitionBy()
    added = {}
    for name, value in ranks.items():
        added[name] = F.dense_rank().over(W.orderBy(F.desc_nulls_last(value)))
    for name, value in percents.items():
        above = F.rank().over(W.orderBy(F.desc_nulls_last(value))) - 1
        others = F.count(F.lit(1)).over(everything) - 1
        added[name] = F.coalesce(percent(above, others), F.lit(0.0))
    return base.withColumns(added)


def global_ranks(
    df: DataFrame,
    ranks: Mapping[str, str],
    percents: Mapping[str, str] | None = None,
    one_task_rows: int = 100_000,
    slots: int | None = None,
) -> DataFrame:
    """Dense ranks (and percent ranks, 0 to 100 with two places) over the whole table, descending.

    ``ranks`` and ``percents`` map new column names to the columns ranked. The input, usually an aggregate, is
    materialised once. Up to ``one_task_rows`` rows a plain window in one task is the cheapest plan; beyond it an
    ordered scan over ``slots`` partitions (by default as many as shuffles have) ranks each column, with no task that
    grows with a value's share of the rows.
    """
    percents = dict(percents or {})
    base = stored(df)
    total = base.count()
    if total <= one_task_rows:
        return _small_ranks(base, ranks, percents)
    result = base
    for value in dict.fromkeys([*ranks.values(), *percents.values()]):
        result = scan.with_ranks(result, value, "_dense", "_above", slots)
        for name, ranked in ranks.items():
            if ranked == value:
                result = result.withColumn(name, F.col("_dense").cast("int"))
        for name, ranked in percents.items():
            if ranked == value:
                share = percent(F.col("_above"), F.lit(total - 1))
                result = result.withColumn(name, F.coalesce(share, F.lit(0.0)))
        result = result.drop("_dense", "_above")
    return result
