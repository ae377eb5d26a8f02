"""Data-quality rules over a table that arrives in batches, without reading earlier batches again.

Row rules count in each batch and add up. Uniqueness and references look across batches: the values seen so far, with
their numbers of rows, are kept in a versioned table in buckets by value, and so are the keys of each referenced table.
A batch reads the buckets of its own values. What it changes is taken from the log of the version it has made, so a
batch that is repeated after a failure comes to the same counts. The results equal :func:`quality.validate` over
everything that has arrived, and every batch leaves its results in a history.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import quality
from tidewell.operators.quality import Rule
from tidewell.sinks.versions import CHANGE, VersionedTable, upserted

VALUE, ROWS = "value", "n"
UNIQUE, REFERENCE = "unique", "referential_integrity"


def _text(value: Column) -> Column:
    """A value as text that tells NULL from every value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _added(before: DataFrame | None, batch: DataFrame) -> DataFrame:
    both = batch if before is None else before.unionByName(batch)
    return both.groupBy(VALUE).agg(F.sum(ROWS).alias(ROWS))


class RuleState:
    """Rules and what they have counted so far, below ``root``. The tables that references name are given in batches too."""

    def __init__(self, spark: SparkSession, root: str, rules: Sequence[Rule], buckets: int = 64) -> None:
        self.spark, self.root, self.rules, self.buckets = spark, root.rstrip("/"), list(rules), buckets
        self.totals = VersionedTable(spark, f"{self.root}/totals", ["rule"], 1, logged=False)

    def _values(self, column: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/values-{column}", [VALUE], self.buckets)

    def _keys(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/keys-{name}", [VALUE], self.buckets)

    def _of(self, table: VersionedTable, values: DataFrame) -> DataFrame:
        """The rows of a table for some values, from the buckets of these values."""
        if not table.versions():
            return self.spark.createDataFrame([], f"{VALUE} string, {ROWS} long")
        # At most ``buckets`` rows.
        buckets = sorted(r[0] for r in values.select(table.bucket(values)).distinct().collect())
        return table.state(buckets=buckets).join(values.select(VALUE), [VALUE], "left_semi")

    def _moved(self, table: VersionedTable, version: int) -> DataFrame:
        """``value, n``: by how many rows a version moved each value, and whether it is ``new``."""
        feed = table.changes(version, version)
        gone = F.col(CHANGE).isin("delete", "update_preimage")
        return feed.groupBy(VALUE).agg(
            F.sum(F.when(gone, -F.col(ROWS)).otherwise(F.col(ROWS))).alias(ROWS), F.max(F.col(CHANGE) == "insert").alias("new")
        )

    def _count(self, rows: DataFrame, at: datetime.datetime, source: str, number: int) -> None:
        """Add ``rule, total_records, failed_records`` to the totals."""

        def step(before: DataFrame | None, more: DataFrame) -> DataFrame:
            both = more if before is None else before.unionByName(more)
            return both.groupBy("rule").agg(F.sum("total_records").alias("total_records"), F.sum("failed_records").alias("failed_records"))

        self.totals.commit(rows, step, at, source, number)
        self.totals.vacuum(1)

    def add(self, batch: DataFrame, number: int, at: datetime.datetime, source: str = "rows") -> None:
        """Count a batch. Batches are numbered; one that was counted before changes nothing."""
        if self.totals.versions() and self.totals.manifest().sources.get(source, -1) >= number:
            return
        plain = [(i, r) for i, r in enumerate(self.rules) if r.kind not in (UNIQUE, REFERENCE)]
        columns = list(dict.fromkeys(r.column for r in self.rules if r.kind in (UNIQUE, REFERENCE)))
        held = batch.persist()
        try:
            total = held.count()
            if not total:
                return
            parts: list[DataFrame] = []
            if plain:
                places = F.array(*[F.lit(i) for i, _ in plain])
                counted = quality.row_counts(held, [r for _, r in plain])
                parts.append(counted.select(places[F.col("place")].alias("rule"), "total_records", "failed_records"))
            for column in columns:
                table = self._values(column)
                counts = held.groupBy(_text(F.col(column)).alias(VALUE)).agg(F.count(F.lit(1)).alias(ROWS))
                moved = self._moved(table, table.commit(counts, _added, at, source, number)).persist()
                for i, rule in enumerate(self.rules):
                    if rule.column == column and rule.kind == UNIQUE:
                        failed = F.sum(ROWS) - F.count_if("new")
                        parts.append(moved.agg(F.lit(i).alias("rule"), F.sum(ROWS).alias("total_records"), failed.alias("failed_records")))
                    elif rule.column == column and rule.kind == REFERENCE:
                        known = self._of(self._keys(rule.option("key")), moved)
                        lost = moved.join(known.select(VALUE, F.lit(True).alias("_known")), [VALUE], "left")
                        failed = F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col(ROWS))), F.lit(0))
                        parts.append(lost.agg(F.lit(i).alias("rule"), F.sum(ROWS).alias("total_records"), failed.alias("failed_records")))
                table.vacuum(2)
            rows = reduce(DataFrame.unionByName, [p.select(F.col("rule").cast("int"), "total_records", "failed_records") for p in parts])
            self._count(rows, at, source, number)
        finally:
            held.unpersist()
        self._remember(at, f"{source}-{number}")

    def add_keys(self, name: str, keys: DataFrame, number: int, at: datetime.datetime) -> None:
        """Keys of the referenced column ``name`` that have arrived; rows that waited for them stop being orphans."""
        source, column = f"keys-{name}", keys.columns[0]
        if self.totals.versions() and self.totals.manifest().sources.get(source, -1) >= number:
            return
        table = self._keys(name)
        fresh = keys.where(F.col(column).isNotNull()).select(_text(F.col(column)).alias(VALUE)).distinct().withColumn(ROWS, F.lit(1).cast("long"))
        before = table.versions()[-1:]
        version = table.commit(fresh, upserted([VALUE]), at, source, number)
        if [version] == before and table.manifest().sources.get(source, -1) < number:
            return
        new = self._moved(table, version).where("new").select(VALUE)
        parts = []
        for i, rule in enumerate(self.rules):
            if rule.kind == REFERENCE and rule.option("key") == name:
                found = self._of(self._values(rule.column), new).agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias("n"))
                parts.append(found.select(F.lit(i).alias("rule"), F.lit(0).cast("long").alias("total_records"), (-F.col("n")).alias("failed_records")))
        table.vacuum(2)
        if parts:
            self._count(reduce(DataFrame.unionByName, parts), at, source, number)
            self._remember(at, f"{source}-{number}")

    def results(self) -> DataFrame:
        """One row per rule, as :func:`quality.validate` gives."""
        return quality.from_counts(self.rules, self.totals.state())

    def _remember(self, at: datetime.datetime, name: str) -> None:
        quality.stamped(self.results(), at).write.mode("overwrite").parquet(f"{self.root}/history/step={name}")

    def history(self) -> DataFrame:
        """The results after every batch, with ``step`` and ``validation_timestamp``."""
        return self.spark.read.parquet(f"{self.root}/history")
