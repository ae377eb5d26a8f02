"""Distinct counts, quantiles and heavy hitters from sketches that are stored per batch and merged.

A sketch has a fixed size, whatever number of rows it stands for, and two of them merge into that of both. So a batch is
read once, when it arrives; any span of batches and any coarser grouping is answered from the stored sketches, without
a rescan and without a group per key. All sketches are Spark's own aggregates, which combine on the map side.

Errors, with the sizes below: a distinct count has a relative standard error of 1.04 / sqrt(2 ** ``LOG_BUCKETS``); a
quantile's rank is off by about 1.4 / ``RANKS`` of the rows; an item's count is too low by at most 3.5 / ``ITEMS`` of
the rows, so no item with a greater share is missed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_BUCKETS = 14
RANKS = 400
ITEMS = 4_096
BATCH = "batch"


def distinct_error() -> float:
    return 1.04 / 2 ** (LOG_BUCKETS / 2)


def rank_error() -> float:
    return 1.4 / RANKS


def count_error() -> float:
    return 3.5 / ITEMS


def _names(df: DataFrame, prefix: str) -> list[str]:
    return [c.removeprefix(prefix) for c in df.columns if c.startswith(prefix)]


def sketched(
    df: DataFrame, group: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = (), frequent: Sequence[str] = ()
) -> DataFrame:
    """One row per group: ``rows``, and for each named column ``distinct_``, ``quantiles_`` or ``frequent_`` with its sketch.

    NULLs are in no sketch. Quantiles are of numbers, as doubles.
    """
    made: list[Column] = [F.count(F.lit(1)).alias("rows")]
    made += [F.hll_sketch_agg(F.col(c), F.lit(LOG_BUCKETS)).alias(f"distinct_{c}") for c in distinct]
    made += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(RANKS)).alias(f"quantiles_{c}") for c in quantiles]
    made += [F.expr(f"approx_top_k_accumulate(`{c}`, {ITEMS})").alias(f"frequent_{c}") for c in frequent]
    return df.groupBy(*group).agg(*made)


def merged(sketches: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups: over batches, or over columns that ``group`` leaves out."""
    made: list[Column] = [F.sum("rows").alias("rows")]
    made += [F.hll_union_agg(f"distinct_{c}").alias(f"distinct_{c}") for c in _names(sketches, "distinct_")]
    made += [F.kll_merge_agg_double(f"quantiles_{c}").alias(f"quantiles_{c}") for c in _names(sketches, "quantiles_")]
    made += [F.expr(f"approx_top_k_combine(`frequent_{c}`, {ITEMS})").alias(f"frequent_{c}") for c in _names(sketches, "frequent_")]
    return sketches.groupBy(*group).agg(*made)


def save(sketches: DataFrame, path: str, batch: int) -> None:
    """Store the sketches of a batch; a batch that is stored again replaces itself."""
    sketches.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def stored(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The stored sketches of a span of batches; folders of other batches are not read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col(BATCH) >= first)
    return rows if last is None else rows.where(F.col(BATCH) <= last)


def estimated(sketches: DataFrame, shares: Mapping[str, Sequence[float]] | None = None, top: int = 10) -> DataFrame:
    """The groups with ``rows``, and for each sketch ``n_`` (distinct count), ``q_`` (array of quantiles at the column's
    ``shares``, by default the quartiles) or ``top_`` (array of ``item, count``, most frequent first)."""
    kept = [c for c in sketches.columns if not c.startswith(("distinct_", "quantiles_", "frequent_"))]
    found = [F.hll_sketch_estimate(f"distinct_{c}").alias(f"n_{c}") for c in _names(sketches, "distinct_")]
    for c in _names(sketches, "quantiles_"):
        at = (shares or {}).get(c, (0.25, 0.5, 0.75))
        none = F.coalesce(F.kll_sketch_get_n_double(f"quantiles_{c}"), F.lit(0)) == 0
        found.append(F.when(~none, F.array(*[F.kll_sketch_get_quantile_double(f"quantiles_{c}", F.lit(float(s))) for s in at])).alias(f"q_{c}"))
    found += [F.expr(f"approx_top_k_estimate(`frequent_{c}`, {top})").alias(f"top_{c}") for c in _names(sketches, "frequent_")]
    return sketches.select(*kept, *found)

