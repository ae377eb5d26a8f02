"""Keyed state maintained from new files, with Spark's checkpoint deciding what is new.

The state is a :class:`tidewell.sinks.versions.VersionedTable`: a batch rewrites only the buckets its keys fall into, a
manifest names the folders that hold the state, and every batch leaves its changes behind. A repeated batch changes
nothing, so a restart does not either. Deleted keys stay as hidden tombstones, so that a late older event cannot
revive them. Of older versions only the one before the latest is kept.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators.ordered import all_columns_order, latest_per_key
from tidewell.sinks.versions import VersionedTable

GONE = "_deleted"


def state_table(spark: SparkSession, state_dir: str, keys: Sequence[str], buckets: int = 64) -> VersionedTable:
    return VersionedTable(spark, state_dir, keys, buckets, hidden=GONE)


def current_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """Rows of the latest state; raises when no batch has run yet."""
    return VersionedTable.opened(spark, state_dir).state()


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    state_dir: str,
    keys: Sequence[str],
    sequence: str,
    is_delete: str | None = None,
    buckets: int = 64,
    source: str = "batch",
    keep: int | None = 2,
    at: datetime.datetime | None = None,
) -> VersionedTable:
    """Merge one batch of changes into the state and return it; the greatest sequence per key wins.

    Batches of a ``source`` are numbered; one that was applied before is not applied again. The latest ``keep`` versions
    stay readable, or all of them.
    """
    gone = F.coalesce(F.expr(is_delete), F.lit(False)) if is_delete else F.lit(False)
    order = [F.desc_nulls_last(sequence), *all_columns_order(batch, skip=[*keys, sequence])]
    changed = latest_per_key(batch, keys, order).withColumn(GONE, gone)

    def newest(before: DataFrame | None, fresh: DataFrame) -> DataFrame:
        if before is None:
            return fresh
        united = before.unionByName(fresh, allowMissingColumns=True)
        rank = [F.desc_nulls_last(sequence), *all_columns_order(united, skip=[*keys, sequence])]
        return latest_per_key(united, keys, rank)

    table = state_table(batch.sparkSession, state_dir, keys, buckets)
    version = table.commit(changed, newest, at or datetime.datetime.now(datetime.timezone.utc), source, batch_id)
    if version and keep:
        table.vacuum(keep)
    return table


def run_incremental(
    spark: SparkSession,
    source_dir: str,
    state_dir: str,
    checkpoint: str,
    schema: StructType,
    keys: Sequence[str],
    sequence: str,
    is_delete: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = 64,
    source_format: str = "parquet",
    files_per_trigger: int | None = None,
) -> None:
    """Process the files that arrived since the last call and merge them into the state.

    Use more ``buckets`` for a larger state: about one file of the target size each.
    """
    reader = spark.readStream.format(source_format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        apply_batch(rows, batch_id, state_dir, keys, sequence, is_delete, buckets, source=checkpoint)

    query = (
        reader.load(source_dir)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
