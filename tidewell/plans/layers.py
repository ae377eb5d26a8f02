"""The layered job that reads only what arrived.

A run takes the files that came since the last one through all layers:

* bronze: the new rows with their audit columns, a folder per delivery;
* silver: their cleaned rows replace or join the rows of their keys, in versioned tables, and what they lost goes to a table
  of rejects. Copies of orders by customer and of payments by order are brought up to date from the change logs;
* enriched orders: an order is made again if its row, one of its payments or its customer changed;
* gold: views are kept from the log of the enriched orders, version by version.

Every step remembers in its own manifest how far it has come, so a run that was broken off is finished by the next
one, and a run without new files changes nothing. Each step reads the buckets of the keys that changed.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import sources
from tidewell.operators import enrich, gold, quality
from tidewell.plans import medallion
from tidewell.sinks.versions import VersionedTable, mirror, upserted
from tidewell.streaming import views

# The raw files.
KINDS = {"orders": "csv", "customers": "csv", "payments": "json"}
AUDIT = ["_ingestion_timestamp", "_source_file", "_batch_id"]


class Layers:
    """The tables below ``root``. ``buckets`` is fixed with the first run: about one file of the target size each."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        made = lambda name, keys, by=None: VersionedTable(spark, f"{self.root}/silver/{name}", keys, buckets, by)
        self.silver = {name: made(name, [key]) for name, key in medallion.KEYS.items()}
        self.by_customer = made("orders_by_customer", ["order_id", "customer_id"], ["customer_id"])
        self.by_order = made("payments_by_order", ["order_id", "payment_id"], ["order_id"])
        self.enriched = made("enriched_orders", ["order_id"])

    # --- bronze and silver --------------------------------------------------------------------

    def land(self, name: str, path: str, batch_id: str, options: Mapping[str, Any], at: datetime.datetime) -> None:
        """New files of one source into bronze, silver and the rejects."""
        checkpoint = f"{self.root}/checkpoints/{name}"

        def delivered(batch: DataFrame, number: int) -> None:
            landed = f"{self.root}/bronze/{name}/delivery={number}"
            batch.write.mode("overwrite").option("compression", "zstd").parquet(landed)
            raw = self.spark.read.schema(batch.schema).parquet(landed)
            lost = medallion.rejects(name, raw)
            lost.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/silver/{name}_rejects/delivery={number}")
            rows, table = medallion.SILVER[name](raw), self.silver[name]
            table.commit(rows, upserted(table.keys), at, "files", number)

        _, schema, _ = medallion.READERS[name]
        stream = sources.with_audit(sources.stream_files(self.spark, path, KINDS[name], schema, **options), batch_id)
        writer = stream.writeStream.foreachBatch(delivered).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    def rejects(self) -> DataFrame:
        """What all deliveries lost."""
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.root}/silver/{name}_rejects") for name in KINDS])

    # --- enriched orders ----------------------------------------------------------------------

    def _changed(self, name: str, column: str, upto: Mapping[str, int]) -> DataFrame | None:
        """The values of ``column`` in both images of what changed in a silver table since the last enrichment."""
        start = self.enriched.mark(name) + 1
        if start > upto[name]:
            return None
        return self.silver[name].changes(start, upto[name]).select(column).where(F.col(column).isNotNull()).distinct()

    def _of(self, table: VersionedTable, keys: DataFrame) -> DataFrame:
        """The rows of a table, bucketed by the column of ``keys``, that have these keys; other buckets are not read."""
        column = keys.columns[0]
        if not table.versions():
            raise FileNotFoundError(f"{table.path}: every source needs a first delivery")
        return table.state(buckets=table.touched(keys)).join(keys, [column], "left_semi")

    def enrich(self, at: datetime.datetime) -> None:
        """Make the orders again that are touched by what changed in silver."""
        upto = {name: max(table.versions(), default=0) for name, table in self.silver.items()}
        people, orders = self._changed("customers", "customer_id", upto), self._changed("orders", "order_id", upto)
        parts = [orders, self._changed("payments", "order_id", upto)]
        if people is not None and self.by_customer.versions():
            parts.append(self._of(self.by_customer, people).select("order_id"))
        found = [p for p in parts if p is not None]
        if not found:
            return
        ids = reduce(DataFrame.union, found).distinct().persist()
        try:
            own = self._of(self.silver["orders"], ids).drop(*AUDIT)
            who = own.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
            paid = enrich.payments_per_order(self._of(self.by_order, ids))
            made = enrich.with_completed_flag(enrich.enriched_orders(own, self._of(self.silver["customers"], who), paid))
            batch = made.select("order_id", *[c for c in made.columns if c != "order_id"])

            def step(before: DataFrame | None, fresh: DataFrame) -> DataFrame:
                # Orders that are touched and not made again are gone.
                return fresh if before is None else before.join(ids, ["order_id"], "left_anti").unionByName(fresh, allowMissingColumns=True)

            self.enriched.commit(batch, step, at, marks=upto, touched=self.enriched.touched(ids))
        finally:
            ids.unpersist()

    def validated(self) -> tuple[DataFrame, DataFrame]:
        """``(valid, quarantined)`` enriched orders."""
        return quality.split(self.enriched.state(), medallion.ORDER_RULES)

    # --- gold ---------------------------------------------------------------------------------

    def refresh_views(self, at: datetime.datetime) -> None:
        """Bring the views up to date, one version of the enriched orders at a time."""
        gold_root, marks = f"{self.root}/gold", f"{self.root}/gold/versions"
        done = VersionedTable(self.spark, marks, ["view"], 1, logged=False)
        for version in range(done.mark("enriched") + 1, max(self.enriched.versions(), default=0) + 1):
            # Each image is valid or not for itself, so an order may enter or leave the views.
            feed, _ = quality.split(self.enriched.changes(version, version), medallion.ORDER_RULES)
            for view in views.VIEWS:
                views.refresh(gold_root, view, feed, at, "enriched", version, self.buckets, again=True)
            names = self.spark.createDataFrame([(v.name, version) for v in views.VIEWS], "view string, version long")
            done.commit(names, upserted(["view"]), at, "enriched", version)
            done.vacuum(1)

    def gold(self, as_of: datetime.date) -> dict[str, DataFrame]:
        """The kept views, and the other gold tables made of all valid orders."""
        read = lambda view: views.read(self.spark, f"{self.root}/gold", view, self.buckets)
        valid, _ = self.validated()
        kept = {
            "daily_revenue": views.daily_revenue(read(views.DAILY)),
            "country_revenue": views.country_revenue(read(views.COUNTRY)),
            "customer_360": views.customer_360(read(views.CUSTOMER), as_of),
        }
        return {
            **kept,
            "top_products": gold.top_products(valid),
            "payment_metrics": gold.payment_metrics(valid),
            "payment_success": gold.payment_success(valid),
            "executive_summary": gold.executive_summary(valid, as_of=as_of),
        }


def run(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    root: str,
    batch_id: str = "manual",
    buckets: int = 64,
    options: Mapping[str, Mapping[str, Any]] | None = None,
    at: datetime.datetime | None = None,
    keep: int = 2,
) -> Layers:
    """Take the new files below ``raw_paths`` through all layers. ``options`` are reader options by source; payments are
    JSON lines unless they say ``multiLine``. The latest ``keep`` versions of the silver tables stay readable."""
    moment = at or datetime.datetime.now(datetime.timezone.utc)
    layers = Layers(spark, root, buckets)
    for name in KINDS:
        layers.land(name, raw_paths[name], batch_id, (options or {}).get(name, {}), moment)
    mirror(layers.silver["orders"], layers.by_customer, ["order_id", "customer_id"], moment)
    if layers.silver["payments"].versions():
        paid = [c for c in layers.silver["payments"].state().columns if c not in AUDIT]
        mirror(layers.silver["payments"], layers.by_order, paid, moment)
    layers.enrich(moment)
    layers.refresh_views(moment)
    for table in [*layers.silver.values(), layers.by_customer, layers.by_order, layers.enriched]:
        if table.versions():
            table.vacuum(keep)
    return layers
