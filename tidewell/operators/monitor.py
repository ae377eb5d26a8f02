"""Score reports: distribution, monitoring metrics, high-risk customers, drift."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import labels
from tidewell.functions.numbers import percent
from tidewell.sinks.tables import overwrite_partitions

SCORE = "churn_probability"
# Histogram bins of the drift measure, the alert threshold and the smallest share.
BINS = 10
DRIFT_THRESHOLD = 0.1
LEAST_SHARE = 1e-6
REPORT_COLUMNS = [SCORE, "recency_days", "frequency", "monetary_value", "cancellation_rate"]


def _quantile(column: str, share: float, exact: bool) -> Column:
    if exact:
        return F.percentile(column, F.lit(share))
    return F.percentile_approx(column, F.lit(share))


def save_predictions(df: DataFrame, path: str, risk: str = "churn_risk", only_touched: bool = False) -> None:
    """Scores as a table partitioned by risk class."""
    overwrite_partitions(df, path, [risk], only_touched)


def score_distribution(df: DataFrame, score: str = SCORE, exact: bool = False) -> DataFrame:
    """One row: count, mean, extremes and median of a score.

    ``exact`` medians keep every distinct score in one task: use them for rounded scores only.
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.avg(score).alias("avg_probability"),
        F.min(score).alias("min_probability"),
        F.max(score).alias("max_probability"),
        _quantile(score, 0.5, exact).alias("median_probability"),
    )


def risk_distribution(df: DataFrame, risk: str = "churn_risk") -> DataFrame:
    return df.groupBy(risk).agg(F.count(F.lit(1)).alias("count"))


def metrics(
    df: DataFrame, score: str = SCORE, risk: str = "churn_risk", exact: bool = False, places: int = 4
) -> DataFrame:
    """One row of monitoring figures from one pass over the scores."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_scored"),
        *[F.count_if(F.col(risk) == level).alias(f"count_{level.lower()}") for level in ("HIGH", "MEDIUM", "LOW")],
        F.round(F.avg(score), places).alias("avg_churn_probability"),
        *[F.round(_quantile(score, p / 100, exact), places).alias(f"p{p}_probability") for p in (25, 50, 75)],
    )
    return counted.withColumn("high_risk_rate", percent(F.col("count_high"), F.col("total_scored")))


def high_risk_report(
    df: DataFrame, n: int = 100, key: str = "customer_id", score: str = SCORE, columns: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` customers with the greatest scores in the HIGH class; ties by key."""
    shown = [key, *(REPORT_COLUMNS if columns is None else columns)]
    high = df.where(F.col("churn_risk") == labels.SCORE_RISKS[0][1])
    return high.orderBy(F.desc(score), F.asc(key)).limit(n).select(*shown)


def save_report(report: DataFrame, path: str, day: datetime.date) -> None:
    """A report under its day; a report of the same day is replaced, those of other days stay."""
    overwrite_partitions(report.withColumn("report_date", F.lit(day)), path, ["report_date"], only_touched=True)


def stored_reports(spark: SparkSession, path: str, day: datetime.date | None = None) -> DataFrame:
    """All stored reports, or that of a day, whose folder alone is read."""
    reports = spark.read.parquet(path)
    return reports if day is None else reports.where(F.col("report_date") == F.lit(day))


def _histogram(df: DataFrame, score: str, name: str) -> DataFrame:
    # Scores lie in 0..1; 1.0 belongs to the last bin.
    index = F.least(F.floor(F.col(score) * BINS), F.lit(BINS - 1))
    return df.where(F.col(score).isNotNull()).groupBy(index.alias("bin")).agg(
        F.count(F.lit(1)).alias(f"{name}_n"), F.sum(score).alias(f"{name}_sum")
    )


def drift(base: DataFrame, current: DataFrame, score: str = SCORE, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """One row: change of the mean, population stability index over ten bins, and an alert.

    Each side is reduced to ten bins before the two meet.
    """
    bins = _histogram(base, score, "base").join(_histogram(current, score, "current"), ["bin"], "full_outer")
    totals = bins.agg(
        F.sum("base_n").alias("base_n"),
        F.sum("current_n").alias("current_n"),
        F.sum("base_sum").alias("base_sum"),
        F.sum("current_sum").alias("current_sum"),
        F.collect_list(F.struct("base_n", "current_n")).alias("bins"),
    )

    def share(n: Column, total: Column) -> Column:
        return F.greatest(F.coalesce(n, F.lit(0)) / total, F.lit(LEAST_SHARE))

    def part(b: Column) -> Column:
        was, now = share(b["base_n"], F.col("base_n")), share(b["current_n"], F.col("current_n"))
        return (now - was) * F.ln(now / was)

    index = F.aggregate("bins", F.lit(0.0), lambda total, b: total + part(b))
    change = F.col("current_sum") / F.col("current_n") - F.col("base_sum") / F.col("base_n")
    return totals.select(
        F.col("base_n").alias("base_records"),
        F.col("current_n").alias("current_records"),
        F.round(change, 6).alias("mean_change"),
        F.round(index, 6).alias("stability_index"),
    ).withColumn("drift_alert", (F.abs("mean_change") > threshold) | (F.col("stability_index") > threshold))
