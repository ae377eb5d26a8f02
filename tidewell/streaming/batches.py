"""Streams that keep state of their own between micro-batches, beyond what a watermark keeps.

Every operator here runs a stream through ``foreachBatch`` and writes what a batch gives into a folder of that batch, or
commits it to a versioned table under the batch's number. Spark may run a batch again after a failure; it then writes
the same folder again, or finds its number committed and does nothing. So each result holds every batch exactly once.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import quality
from tidewell.operators.ordered import all_columns_order, latest_per_key
from tidewell.sinks import store
from tidewell.sinks.versions import VersionedTable, upserted

BATCH = "batch"
ONCE = {"availableNow": True}


def each_batch(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", trigger: Mapping[str, Any] | None = None
) -> None:
    """Run ``apply`` on every micro-batch; by default on all that is there, and then stop."""
    writer = stream.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint)
    writer.trigger(**(trigger or ONCE)).start().awaitTermination()


def _write(rows: DataFrame, path: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")


def written(spark: SparkSession, path: str) -> DataFrame:
    """What the batches have written so far, with the column ``batch``."""
    return spark.read.option("mergeSchema", True).parquet(path)


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


# --- late events ------------------------------------------------------------------------------


def watermark(spark: SparkSession, path: str, before: int) -> int | None:
    """Microseconds of the greatest event time of the batches before a batch; None if there is none."""
    done = [int(n) for n in store.names(spark, path) if n.isdigit() and int(n) < before]
    text = store.read_text(spark, f"{path}/{max(done)}") if done else None
    return int(text) if text else None


def split_late(stream: DataFrame, out: str, late: str, checkpoint: str, delay: datetime.timedelta, time: str = "event_timestamp") -> None:
    """Rows on time to ``out`` and rows that are too late to ``late``, so that a late row is seen instead of dropped.

    A row is late if its time lies more than ``delay`` before the greatest time of all earlier batches: what a watermark
    of that delay would drop. A row without a time is on time nowhere, and goes to ``late``.
    """
    marks = f"{late.rstrip('/')}_watermarks"

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = watermark(spark, marks, number)
        held = batch.persist()
        try:
            micros = F.unix_micros(F.col(time).cast("timestamp"))
            limit = None if seen is None else seen - int(delay / datetime.timedelta(microseconds=1))
            behind = micros.isNull() if limit is None else micros.isNull() | (micros < F.lit(limit))
            _write(held.where(~behind), out, number)
            _write(held.where(behind), late, number)
            newest = held.agg(F.max(micros)).first()[0]
        finally:
            held.unpersist()
        greatest = max((v for v in (seen, newest) if v is not None), default=None)
        store.delete(spark, f"{marks}/{number}")
        store.write_text(spark, f"{marks}/{number}", "" if greatest is None else str(greatest))

    each_batch(stream, apply, checkpoint)


# --- first copies for good --------------------------------------------------------------------


def first_copies(
    stream: DataFrame,
    out: str,
    seen_dir: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str = "event_timestamp",
    keep: datetime.timedelta | None = None,
    buckets: int = 64,
) -> None:
    """The first copy of every key, however late the next ones come.

    Keys that were seen are kept in a versioned table; a batch reads the buckets of its keys only. With ``keep``, a key
    whose time lies further back than that from the newest one of a batch is forgotten when its bucket is written
    again.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table = VersionedTable(spark, seen_dir, keys, buckets, logged=False)
        if table.versions() and table.manifest().sources.get(checkpoint, -1) >= number:
            return
        order = [F.asc_nulls_last(time), *all_columns_order(batch, skip=[*keys, time])]
        first = latest_per_key(batch, keys, order).persist()
        try:
            fresh = first
            if table.versions():
                # At most ``buckets`` rows.
                touched = sorted(r[0] for r in first.select(table.bucket(first)).distinct().collect())
                fresh = first.join(table.state(buckets=touched).select(*keys), list(keys), "left_anti")
            _write(fresh, out, number)
            own = spark.read.schema(fresh.schema).parquet(f"{out}/{BATCH}={number}").select(*keys, F.col(time).alias("_seen_at"))

            def step(before: DataFrame | None, more: DataFrame) -> DataFrame:
                known = more if before is None else before.unionByName(more)
                if keep is None:
                    return known
                horizon = more.agg(F.max("_seen_at")).first()[0]
                return known if horizon is None else known.where(F.col("_seen_at") >= F.lit(horizon - keep))

            table.commit(own, step, _now(), checkpoint, number)
            if table.versions():
                table.vacuum(2)
        finally:
            first.unpersist()

    each_batch(stream, apply, checkpoint)


# --- open windows -----------------------------------------------------------------------------


def keep_windows(windows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int = 16) -> VersionedTable:
    """Windows in update mode: the table has the latest figures of every window, open ones included.

    Each batch brings the windows that changed; their rows replace the earlier ones.
    """

    def apply(batch: DataFrame, number: int) -> None:
        VersionedTable(batch.sparkSession, path, keys, buckets).commit(batch, upserted(keys), _now(), checkpoint, number)

    each_batch(windows, apply, checkpoint, mode="update")
    table = VersionedTable(windows.sparkSession, path, keys, buckets)
    if table.versions():
        table.vacuum(2)
    return table


# --- expectations -----------------------------------------------------------------------------


def checked(
    stream: DataFrame,
    out: str,
    history: str,
    checkpoint: str,
    rules: Mapping[str, str | Column],
    actions: Mapping[str, str] | None = None,
) -> None:
    """Write the rows of a stream under expectations and keep a history of how many rows met each, batch by batch.

    ``actions`` names what a broken rule does: ``warn`` (the default) keeps the row, ``drop`` leaves it out, ``fail`` stops the
    stream before any row of the batch is written. The counts are taken while the batch is written, with no pass of
    their own; only rules that can fail are counted first.
    """
    acts = {name: (actions or {}).get(name, "warn") for name in rules}
    if unknown := set(acts.values()) - {"warn", "drop", "fail"}:
        raise ValueError(f"unknown actions {sorted(unknown)}")

    def apply(batch: DataFrame, number: int) -> None:
        from pyspark.sql import Observation

        spark = batch.sparkSession
        fatal = {n: p for n, p in rules.items() if acts[n] == "fail"}
        if fatal:
            quality.expect(batch, fatal, "fail")
        counts = Observation(f"expectations-{number}")
        watched = quality.observe_expectations(batch, rules, counts)
        dropping = [quality.holds(rules[n]) for n, a in acts.items() if a == "drop"]
        for rule in dropping:
            watched = watched.where(rule)
        _write(watched, out, number)
        found = counts.get
        rows = [(name, acts[name], found["total"] - found[name], found[name]) for name in rules]
        taken = spark.createDataFrame(rows, "expectation string, action string, passed_records long, failed_records long")
        _write(taken.withColumn("checked_at", F.current_timestamp()), history, number)

    each_batch(stream, apply, checkpoint)


def rule_history(spark: SparkSession, history: str) -> DataFrame:
    """``batch, expectation, action, passed_records, failed_records, checked_at`` of every batch so far."""
    try:
        return written(spark, history)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = "expectation string, action string, passed_records long, failed_records long, checked_at timestamp, batch int"
        return spark.createDataFrame([], schema)
