"""Data-quality rules, expectations, quarantine and table profiles.

Row and uniqueness rules compile into one aggregate over the table, however many there are; Spark
groups the distinct values of each unique column before it counts them. A reference rule adds one
join of grouped values.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tidewell.functions.numbers import percent
from tidewell.functions.text import EMAIL_PATTERN
from tidewell.session import stored

ERROR, WARNING, INFO = "error", "warning", "info"
RESULT_COLUMNS = [
    "rule_name",
    "column",
    "level",
    "passed",
    "total_records",
    "failed_records",
    "failure_rate",
    "message",
]
# Share of bad rows above which a rule raises an alert, in general and by kind, and
# the least number of rows a table should have.
ALERT_SHARE = 0.05
SHARES = {"not_null": 0.01, "unique": 0.0}
MIN_RECORDS = 100


@dataclass(frozen=True)
class Rule:
    """One check of one column; ``options`` depend on the kind."""

    kind: str
    column: str
    level: str = ERROR
    options: tuple[tuple[str, Any], ...] = ()

    def option(self, name: str) -> Any:
        return dict(self.options).get(name)


def _rules(kind: str, columns: Sequence[str], level: str, **options: Any) -> list[Rule]:
    return [Rule(kind, c, level, tuple(options.items())) for c in columns]


def not_null(*columns: str, level: str = ERROR) -> list[Rule]:
    """Fails for NULL and, in floating columns, for NaN."""
    return _rules("not_null", columns, level)


def unique(*columns: str, level: str = ERROR) -> list[Rule]:
    """Counts rows beyond the first of each value; NULL is one value."""
    return _rules("unique", columns, level)


def positive(*columns: str, level: str = ERROR) -> list[Rule]:
    return _rules("positive", columns, level)


def between(column: str, low: Any, high: Any, level: str = ERROR) -> list[Rule]:
    """Bounds are allowed values."""
    return _rules("range", [column], level, low=low, high=high)


def in_set(column: str, values: Sequence[Any], level: str = ERROR) -> list[Rule]:
    return _rules("in_set", [column], level, values=tuple(values))


def matches(column: str, pattern: str, level: str = WARNING) -> list[Rule]:
    """Regular-expression search; anchor the pattern for a full match."""
    return _rules("regex", [column], level, pattern=pattern)


def email(column: str, level: str = WARNING) -> list[Rule]:
    return matches(column, EMAIL_PATTERN, level)


def length(column: str, low: int | None = None, high: int | None = None, level: str = WARNING) -> list[Rule]:
    """Text length bounds; 0 is a bound like any other."""
    return _rules("length", [column], level, low=low, high=high)


def references(column: str, table: DataFrame, key: str, level: str = ERROR) -> list[Rule]:
    """Every value must exist in ``table[key]``; NULL does not."""
    return _rules("referential_integrity", [column], level, table=table, key=key)


def from_config(entries: Sequence[Mapping[str, Any]]) -> list[Rule]:
    """Rules from plain mappings such as ``{"column": "x", "rule": "range", "min": 0, "max": 9}``."""
    made: list[Rule] = []
    for entry in entries:
        column, kind = entry["column"], entry["rule"]
        extra = {"level": entry["level"]} if "level" in entry else {}
        if kind == "range":
            made += between(column, entry.get("min"), entry.get("max"), **extra)
        elif kind == "length":
            made += length(column, entry.get("min"), entry.get("max"), **extra)
        elif kind == "in_set":
            made += in_set(column, entry["values"], **extra)
        elif kind == "regex":
            made += matches(column, entry["pattern"], **extra)
        elif kind in ("not_null", "unique", "positive", "email"):
            simple = {"not_null": not_null, "unique": unique, "positive": positive, "email": email}
            made += simple[kind](column, **extra)
        else:
            raise ValueError(f"unknown rule {kind!r}")
    return made


def _outside(value: Column, low: Any, high: Any) -> Column:
    sides = []
    if low is not None:
        sides.append(value < F.lit(low))
    if high is not None:
        sides.append(value > F.lit(high))
    return reduce(Column.__or__, sides, F.lit(False))


def _violation(df: DataFrame, rule: Rule) -> Column:
    """True for a bad row; NULL or false otherwise."""
    value = F.col(rule.column)
    if rule.kind == "not_null":
        floating = isinstance(df.schema[rule.column].dataType, (DoubleType, FloatType))
        return value.isNull() | F.isnan(value) if floating else value.isNull()
    if rule.kind == "positive":
        return value <= 0
    if rule.kind == "range":
        return _outside(value, rule.option("low"), rule.option("high"))
    if rule.kind == "in_set":
        return ~value.isin(list(rule.option("values")))
    if rule.kind == "regex":
        return ~value.rlike(rule.option("pattern"))
    if rule.kind == "length":
        return _outside(F.length(value), rule.option("low"), rule.option("high"))
    raise ValueError(f"{rule.kind} is not a row rule")


# What a failing row is called in the message.
_COMPLAINTS = {
    "not_null": "null values",
    "unique": "duplicate values",
    "positive": "non-positive values",
    "range": "values outside range",
    "in_set": "values not in allowed set",
    "regex": "values not matching pattern",
    "length": "values with invalid length",
    "referential_integrity": "orphan records",
}


def _raw_result(rule: Rule, failed: Column) -> Column:
    """The parts of a result that differ by rule."""
    texts = {"rule_name": rule.kind, "column": rule.column, "level": rule.level, "what": _COMPLAINTS[rule.kind]}
    return F.struct(failed.alias("failed_records"), *[F.lit(v).alias(n) for n, v in texts.items()])


def _finished(raw: DataFrame) -> DataFrame:
    """Pass flag, failure rate and message for rows of ``total_records`` and :func:`_raw_result`."""
    failed = F.col("failed_records")
    return raw.withColumns(
        {
            "passed": failed == 0,
            "failure_rate": F.coalesce(percent(failed, F.col("total_records")), F.lit(0.0)),
            "message": F.format_string("Column '%s' has %d %s", "column", failed, "what"),
        }
    ).select(*RESULT_COLUMNS)


def row_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``place`` (in ``rules``), ``total_records`` and ``failed_records`` of row rules: counts that add up over batches."""
    failed = [F.count_if(_violation(df, rule)).alias(f"bad_{i}") for i, rule in enumerate(rules)]
    measured = df.agg(F.count(F.lit(1)).alias("total_records"), *failed)
    rows = [F.struct(F.lit(i).alias("place"), F.col(f"bad_{i}").alias("failed_records")) for i in range(len(rules))]
    return measured.select("total_records", F.inline(F.array(*rows)))


def from_counts(rules: Sequence[Rule], counts: DataFrame) -> DataFrame:
    """Results from ``rule`` (the place in ``rules``), ``total_records`` and ``failed_records``."""
    raw = F.lit(None)
    for i, rule in enumerate(rules):
        raw = F.when(F.col("rule") == i, _raw_result(rule, F.col("failed_records"))).otherwise(raw)
    return _finished(counts.select("total_records", raw.alias("_raw")).select("total_records", "_raw.*"))


def _table_results(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    failures = []
    for rule in rules:
        if rule.kind == "unique":
            value = F.col(rule.column)
            values = F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("int")), F.lit(0))
            failures.append(F.count(F.lit(1)) - values)
        else:
            failures.append(F.count_if(_violation(df, rule)))
    measured = df.agg(F.count(F.lit(1)).alias("total_records"), *[f.alias(f"bad_{i}") for i, f in enumerate(failures)])
    rows = [_raw_result(r, F.col(f"bad_{i}")) for i, r in enumerate(rules)]
    return measured.select("total_records", F.inline(F.array(*rows)))


def orphans(df: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """Rows whose value is missing from ``table[key]``, NULL included."""
    known = table.select(F.col(key).alias("_known")).distinct()
    return df.join(known, F.col(column) == F.col("_known"), "left_anti")


def matched_rows(df: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """The complement of :func:`orphans`."""
    known = table.select(F.col(key).alias("_known")).distinct()
    return df.join(known, F.col(column) == F.col("_known"), "left_semi")


def _reference_result(df: DataFrame, rule: Rule) -> DataFrame:
    # Counting per value first keeps a crowded value out of the join.
    values = df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("n"))
    known = rule.option("table").select(F.col(rule.option("key")).alias("_known")).distinct()
    joined = values.join(known, F.col(rule.column) == F.col("_known"), "left")
    counted = joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("failed"),
    )
    return counted.select("total_records", F.inline(F.array(_raw_result(rule, F.col("failed")))))


def validate(df: DataFrame, rules: Sequence[Rule], once: bool = False) -> DataFrame:
    """One row per rule with counts, failure rate in percent and a message.

    Row and uniqueness rules share one pass, each reference takes one of its own column. ``once`` first materialises
    the columns that rules look at: for a ``df`` that is dear to compute, such as a join.
    """
    if once:
        df = stored(df.select(*dict.fromkeys(r.column for r in rules)), "validated")
    own = [r for r in rules if r.kind != "referential_integrity"]
    parts = [_table_results(df, own)] if own else []
    parts += [_reference_result(df, r) for r in rules if r.kind == "referential_integrity"]
    return _finished(reduce(DataFrame.unionByName, parts))


def summary(results: DataFrame) -> DataFrame:
    """One row: rule counts, pass rate, and FAILED when any rule of level error failed."""
    failed = ~F.col("passed")
    counted = results.agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if("passed").alias("passed_rules"),
        F.count_if(failed).alias("failed_rules"),
        F.count_if(failed & (F.col("level") == ERROR)).alias("errors"),
        F.count_if(failed & (F.col("level") == WARNING)).alias("warnings"),
    )
    rate = F.coalesce(percent(F.col("passed_rules"), F.col("total_rules")), F.lit(0.0))
    status = F.when(F.col("errors") > 0, "FAILED").otherwise("PASSED")
    return counted.withColumns({"pass_rate": rate, "status": status})


def alerts(results: DataFrame, share: float = ALERT_SHARE) -> DataFrame:
    """Rules whose failing share of rows exceeds ``share``."""
    return results.where(F.col("failed_records") > F.col("total_records") * F.lit(share))


def breaches(results: DataFrame, shares: Mapping[str, float] = SHARES, min_records: int = MIN_RECORDS) -> DataFrame:
    """Rules over the allowed share of their kind, or measured on a table with too few rows."""
    limit = F.lit(None).cast("double")
    for kind, share in shares.items():
        limit = F.when(F.col("rule_name") == kind, F.lit(float(share))).otherwise(limit)
    over = F.col("failed_records") > F.col("total_records") * limit
    return results.where(F.coalesce(over, F.lit(False)) | (F.col("total_records") < min_records))


def stamped(results: DataFrame, at: datetime.datetime | None = None) -> DataFrame:
    """Results with a ``validation_timestamp``, ready to append to a history table."""
    moment = F.current_timestamp() if at is None else F.lit(at)
    return results.withColumn("validation_timestamp", moment)


# --- expectations -----------------------------------------------------------------------------


class ExpectationError(RuntimeError):
    """Raised by ``expect(..., action="fail")``."""


def holds(predicate: str | Column) -> Column:
    """A predicate that is false where it is unknown."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(condition, F.lit(False))


def expectation_metrics(df: DataFrame, expectations: Mapping[str, str | Column]) -> DataFrame:
    """One row per expectation: rows that hold and rows that do not (unknown counts as not)."""
    counts = [F.count_if(holds(p)).alias(f"ok_{i}") for i, p in enumerate(expectations.values())]
    measured = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    rows = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.col(f"ok_{i}").alias("passed_records"),
            (F.col("total") - F.col(f"ok_{i}")).alias("failed_records"),
        )
        for i, name in enumerate(expectations)
    ]
    return measured.select(F.inline(F.array(*rows)))


def expect(
    df: DataFrame, expectations: Mapping[str, str | Column], action: str = "warn"
) -> tuple[DataFrame, DataFrame]:
    """Rows and metrics. ``warn`` keeps all rows, ``drop`` keeps rows where every predicate is
    true, ``fail`` counts first and raises if any row violates."""
    metrics = expectation_metrics(df, expectations)
    if action == "warn":
        return df, metrics
    if action == "drop":
        return df.where(reduce(Column.__and__, [holds(p) for p in expectations.values()])), metrics
    if action == "fail":
        broken = metrics.where(F.col("failed_records") > 0).collect()
        if broken:
            raise ExpectationError(", ".join(f"{r.expectation}: {r.failed_records} rows" for r in broken))
        return df, metrics
    raise ValueError(f"unknown action {action!r}")


def observe_expectations(
    df: DataFrame, expectations: Mapping[str, str | Column], observation: Observation | str
) -> DataFrame:
    """The same counts as a side effect of the next action (or of every micro-batch), with no
    pass of their own: metrics ``total`` and one failure count per expectation name."""
    failed = [F.count_if(~holds(p)).alias(name) for name, p in expectations.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("total"), *failed)


def split(
    df: DataFrame, rules: Mapping[str, str | Column], at: datetime.datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)``: every row lands in exactly one side.

    A row is valid when every predicate is true. Quarantined rows carry the names of the broken
    rules in ``reasons`` and a ``quarantine_timestamp``.
    """
    broken = [F.when(~holds(p), F.lit(name)) for name, p in rules.items()]
    judged = df.withColumn("reasons", F.array_compact(F.array(*broken)))
    moment = F.current_timestamp() if at is None else F.lit(at)
    valid = judged.where(F.size("reasons") == 0).drop("reasons")
    quarantined = judged.where(F.size("reasons") > 0).withColumn("quarantine_timestamp", moment)
    return valid, quarantined


# --- profiles ---------------------------------------------------------------------------------


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, least and greatest value as text.

    The distinct count is approximate and shares the one aggregate; ``exact`` adds one grouped
    count per column, each of which reads only its column.
    """
    columns = list(columns or df.columns)
    measures = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(columns):
        measures += [
            F.count(c).alias(f"n_{i}"),
            F.min(c).cast("string").alias(f"low_{i}"),
            F.max(c).cast("string").alias(f"high_{i}"),
        ]
        if not exact:
            measures.append(F.approx_count_distinct(c).alias(f"d_{i}"))
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("total").alias("row_count"),
            (F.col("total") - F.col(f"n_{i}")).alias("null_count"),
            F.col(f"low_{i}").alias("min_value"),
            F.col(f"high_{i}").alias("max_value"),
            *([] if exact else [F.col(f"d_{i}").alias("distinct_count")]),
        )
        for i, c in enumerate(columns)
    ]
    report = df.agg(*measures).select(F.inline(F.array(*rows)))
    if not exact:
        return report
    counts = [
        df.agg(F.count_distinct(c).alias("distinct_count")).select(F.lit(c).alias("column"), "distinct_count")
        for c in columns
    ]
    return report.join(reduce(DataFrame.unionByName, counts), "column")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of every numeric column, one aggregate."""
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])
    measures = {"count": F.count, "mean": F.mean, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    named = {
        f"{name}_{i}": measure(c).cast("bigint" if name == "count" else "double")
        for i, c in enumerate(columns)
        for name, measure in measures.items()
    }
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in measures])
        for i, c in enumerate(columns)
    ]
    return df.agg(*[v.alias(n) for n, v in named.items()]).select(F.inline(F.array(*rows)))
