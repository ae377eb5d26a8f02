"""Aggregates kept up to date from a change feed, without reading the rows they were made of.

A view is kept as *partial sums*: signed sums per group and detail, where an inserted row counts once and a row that is
taken back counts minus once. Sums of sums are sums, so a batch costs its own partial sums and the buckets its groups
fall into. The details are what sums alone cannot give back after a deletion: a distinct count is the number of details
left, an extreme the greatest detail left. The *figures*, one row per group, are made again for the touched buckets only.

All tables of a view are versioned tables in buckets by group, so an update that is repeated after a failure finds
what was already done and goes on from there.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewell.functions import labels
from tidewell.functions.numbers import MONEY
from tidewell.operators import gold
from tidewell.sinks.versions import CHANGE, VersionedTable

ROWS = "_rows"


def known(column: str) -> str:
    """The name under which values of ``column`` that are not NULL are counted."""
    return f"{column}_known"


@dataclass(frozen=True)
class Partial:
    """Sums of ``sums`` per group and ``detail``."""

    detail: Sequence[str]
    sums: Sequence[str] = ()


@dataclass(frozen=True)
class View:
    """An aggregate over rows that meet ``where``: partial sums by name, and the figures made of them."""

    name: str
    group: Sequence[str]
    partials: Mapping[str, Partial]
    figures: Callable[[Mapping[str, DataFrame]], DataFrame]
    where: str = "true"


def as_inserts(rows: DataFrame) -> DataFrame:
    """The feed that brings all of ``rows`` into an empty table."""
    return rows.withColumn(CHANGE, F.lit("insert"))


def signed_rows(feed: DataFrame, view: View, partial: Partial) -> DataFrame:
    """The rows of a feed as partial sums of their own, not yet summed: :func:`added` sums them with those that are there."""
    sign = F.when(F.col(CHANGE).isin("insert", "update_postimage"), F.lit(1)).otherwise(F.lit(-1)).cast("long")
    kinds = {f.name: f.dataType for f in feed.schema.fields}
    values = [sign.alias(ROWS)]
    for c in partial.sums:
        wide = f"decimal(28,{kinds[c].scale})" if isinstance(kinds[c], DecimalType) else "long"
        value = F.coalesce(F.col(c).cast(wide), F.lit(0).cast(wide))
        values.append(F.when(sign == 1, value).otherwise(-value).cast(wide).alias(c))
        values.append(F.when(F.col(c).isNotNull(), sign).otherwise(F.lit(0).cast("long")).alias(known(c)))
    return feed.where(view.where).select(*view.group, *partial.detail, *values)


def partial_sums(feed: DataFrame, view: View, partial: Partial) -> DataFrame:
    """Signed sums of a feed: images before a change are taken away, images after it are added."""
    sign = F.when(F.col(CHANGE).isin("insert", "update_postimage"), F.lit(1)).otherwise(F.lit(-1))
    signed = lambda c: F.when(sign == 1, F.col(c)).otherwise(-F.col(c))
    kinds = {f.name: f.dataType for f in feed.schema.fields}
    wide = lambda c: f"decimal(28,{kinds[c].scale})" if isinstance(kinds[c], DecimalType) else "long"
    sums = [F.sum(sign).alias(ROWS)]
    for c in partial.sums:
        sums.append(F.coalesce(F.sum(signed(c)), F.lit(0)).cast(wide(c)).alias(c))
        sums.append(F.coalesce(F.sum(F.when(F.col(c).isNotNull(), sign)), F.lit(0)).alias(known(c)))
    return feed.where(view.where).groupBy(*view.group, *partial.detail).agg(*sums)


def added(before: DataFrame | None, more: DataFrame, view: View, partial: Partial) -> DataFrame:
    """Two tables of partial sums as one; what no row is left of goes."""
    both = more if before is None else before.unionByName(more)
    kinds = dict(more.dtypes)
    values = [ROWS, *[name for c in partial.sums for name in (c, known(c))]]
    summed = both.groupBy(*view.group, *partial.detail).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in values])
    return summed.where(F.col(ROWS) != 0)


def _tables(spark: SparkSession, root: str, view: View, buckets: int) -> tuple[dict[str, VersionedTable], VersionedTable]:
    partials = {
        name: VersionedTable(spark, f"{root}/{view.name}/{name}", [*view.group, *p.detail], buckets, view.group, logged=False)
        for name, p in view.partials.items()
    }
    return partials, VersionedTable(spark, f"{root}/{view.name}/figures", list(view.group), buckets, logged=False)


def refresh(
    root: str,
    view: View,
    feed: DataFrame,
    at: datetime.datetime,
    source: str = "feed",
    number: int | None = None,
    buckets: int = 64,
    keep: int = 2,
    again: bool = False,
) -> None:
    """Bring a view up to date with a feed. Feeds of a ``source`` are numbered; one applied before changes nothing.

    A feed that lies in files may be read ``again``; of any other one the rows are kept while they are summed."""
    spark = feed.sparkSession
    tables, figures = _tables(spark, root, view, buckets)
    touched: set[int] = set()
    for name, partial in view.partials.items():
        table = tables[name]
        delta = signed_rows(feed, view, partial)
        if not again:
            delta.persist()
        try:
            own = table.touched(delta)
            touched |= set(own)
            # The feed is summed once, together with the sums that are there.
            table.commit(delta, lambda before, more, p=partial: added(before, more, view, p), at, source, number, touched=own)
        finally:
            if not again:
                delta.unpersist()
    if touched:
        places = sorted(touched)
        made = view.figures({name: table.state(buckets=places) for name, table in tables.items()})
        figures.commit(made, lambda before, fresh: fresh, at, source, number, touched=places)
    for table in [*tables.values(), figures]:
        if table.versions():
            table.vacuum(keep)


def read(spark: SparkSession, root: str, view: View, buckets: int = 64) -> DataFrame:
    """The figures of a view, one row per group."""
    return _tables(spark, root, view, buckets)[1].state()


def whole(rows: DataFrame, view: View) -> DataFrame:
    """The figures made of all rows at once."""
    return view.figures({name: partial_sums(as_inserts(rows), view, p) for name, p in view.partials.items()})


# --- the views --------------------------------------------------------------------------------


def _sum_of(column: str, kind: str) -> Column:
    """A sum that is NULL where no value is known."""
    return F.when(F.sum(known(column)) > 0, F.sum(column)).cast(kind)


def _per_day(parts: Mapping[str, DataFrame]) -> DataFrame:
    return (
        parts["buyers"]
        .groupBy("order_date")
        .agg(
            F.sum(ROWS).alias("total_orders"),
            F.count("customer_id").alias("unique_customers"),
            _sum_of("total_amount", MONEY).alias("gross_revenue"),
            _sum_of("payment_amount", MONEY).alias("collected_revenue"),
            F.sum(known("total_amount")).alias("priced"),
            _sum_of("quantity", "long").alias("total_items_sold"),
        )
    )


def _per_country(parts: Mapping[str, DataFrame]) -> DataFrame:
    sums = (
        parts["buyers"]
        .groupBy("customer_country")
        .agg(
            F.sum(ROWS).alias("total_orders"),
            F.count("customer_id").alias("total_customers"),
            _sum_of("total_amount", MONEY).alias("total_revenue"),
            F.sum(known("total_amount")).alias("priced"),
        )
    )
    extremes = parts["amounts"].groupBy(F.col("customer_country").alias("_country")).agg(
        F.max("total_amount").alias("max_order_value"), F.min("total_amount").alias("min_order_value")
    )
    return sums.join(extremes, F.col("customer_country").eqNullSafe(F.col("_country"))).drop("_country")


_WHO = ["customer_id", "customer_name", "customer_email", "customer_country"]


def _per_customer(parts: Mapping[str, DataFrame]) -> DataFrame:
    having = lambda status: F.coalesce(F.sum(F.when(F.col("order_status") == status, F.col(ROWS))), F.lit(0))
    return (
        parts["days"]
        .groupBy(*_WHO)
        .agg(
            F.sum(ROWS).alias("total_orders"),
            having(labels.COMPLETED).alias("completed_orders"),
            having(labels.CANCELLED).alias("cancelled_orders"),
            having(labels.PENDING).alias("pending_orders"),
            _sum_of("total_amount", MONEY).alias("total_spent"),
            F.sum(known("total_amount")).alias("priced"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
            F.min("registration_date").alias("registered"),
        )
    )


_COMPLETED = f"order_status = '{labels.COMPLETED}'"
DAILY = View(
    "daily_revenue", ["order_date"],
    {"buyers": Partial(["customer_id"], ["total_amount", "payment_amount", "quantity"])}, _per_day, _COMPLETED,
)
COUNTRY = View(
    "country_revenue", ["customer_country"],
    {"buyers": Partial(["customer_id"], ["total_amount"]), "amounts": Partial(["total_amount"])}, _per_country, _COMPLETED,
)
CUSTOMER = View(
    "customer_360", _WHO, {"days": Partial(["order_date", "order_status", "registration_date"], ["total_amount"])}, _per_customer
)
VIEWS = [DAILY, COUNTRY, CUSTOMER]


def daily_revenue(per_day: DataFrame) -> DataFrame:
    return gold.daily_figures(per_day)


def country_revenue(per_country: DataFrame, **rank_options: int) -> DataFrame:
    return gold.country_figures(per_country, **rank_options)


def customer_360(per_customer: DataFrame, as_of: datetime.date) -> DataFrame:
    return gold.customer_figures(per_customer, as_of)
