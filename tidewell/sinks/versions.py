"""Versioned tables on Parquet: a commit rewrites the buckets its keys fall into and logs what changed.

A table folder holds

* ``state/version=<v>/bucket=<b>``: the rows of a bucket as of the version that last rewrote it;
* ``changes/version=<v>``: what version ``v`` changed, appended once and never rewritten;
* ``manifest/<v>.json``: which version holds each bucket, the columns, the time, and the last batch of every source.

The manifest is written last and makes a version visible. A run that dies before that leaves folders which nobody
reads and the next run overwrites. A version is read from the folders its manifest names, so older versions stay
readable until :meth:`VersionedTable.vacuum`; a range of changes is read from its own folders, whatever the size of
the table. Commits come from one writer at a time.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.operators import cdc
from tidewell.sinks import store

BUCKET = "_bucket"
CHANGE, VERSION, TIME = "_change_type", "_commit_version", "_commit_timestamp"
NONE = 0


@dataclass(frozen=True)
class Manifest:
    """One version: bucket ``b`` lies in the folder of version ``held[b]``; ``NONE`` marks an empty bucket."""

    version: int
    committed_at: str
    held: list[int]
    schema: str
    sources: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


# Next rows of the touched buckets from their previous rows (None at first) and the batch.
Step = Callable[[DataFrame | None, DataFrame], DataFrame]


class VersionedTable:
    """A table of unique ``keys`` kept in ``buckets`` by the hash of ``bucket_by`` (default: the keys).

    ``hidden`` names a boolean column that marks rows which are kept, but are no part of the table (tombstones). A table
    that is not ``logged`` has no change folders.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int = 64,
        bucket_by: Sequence[str] | None = None,
        hidden: str | None = None,
        logged: bool = True,
    ) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.bucket_by, self.hidden, self.logged = list(bucket_by or keys), hidden, logged
        own = {"keys": self.keys, "buckets": buckets, "bucket_by": self.bucket_by, "hidden": hidden, "logged": logged}
        stored = store.read_text(spark, f"{self.path}/table.json")
        if stored is None:
            store.write_text(spark, f"{self.path}/table.json", json.dumps(own))
        elif json.loads(stored) != own:
            kept = json.loads(stored)
            raise ValueError(f"{path} is kept in {kept['buckets']} buckets by {kept['bucket_by']} with keys {kept['keys']}, not as {own}")

    @classmethod
    def opened(cls, spark: SparkSession, path: str) -> VersionedTable:
        """The table of a folder, as it was made."""
        stored = store.read_text(spark, f"{path.rstrip('/')}/table.json")
        if stored is None:
            raise FileNotFoundError(f"{path}: no state yet")
        return cls(spark, path, **json.loads(stored))

    # --- versions -----------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Versions that can be read, oldest first."""
        return sorted(int(name.removesuffix(".json")) for name in store.names(self.spark, f"{self.path}/manifest") if name.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The manifest of a version, by default the latest; None if there is none."""
        if version is None:
            version = max(self.versions(), default=NONE)
        text = store.read_text(self.spark, f"{self.path}/manifest/{version}.json")
        return Manifest(**json.loads(text)) if text else None

    def history(self) -> DataFrame:
        """``version, committed_at`` and the number of buckets each readable version rewrote."""
        wrote = F.size(F.filter(F.from_json("held", "array<long>"), lambda v: v == F.col("version")))
        rows = self.spark.read.schema("version long, committed_at string, held string").json(f"{self.path}/manifest")
        return rows.select("version", F.to_timestamp("committed_at").alias("committed_at"), wrote.alias("buckets"))

    def version_at(self, moment: datetime.datetime) -> int | None:
        """The latest readable version that was committed at or before ``moment``."""
        return self.history().where(F.col("committed_at") <= F.lit(moment)).agg(F.max("version")).first()[0]

    # --- reading ------------------------------------------------------------------------------

    def bucket(self, df: DataFrame):
        """The bucket of a row; equal values of other integer types or of text in other columns do not share it."""
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.bucket_by]), F.lit(self.buckets)).cast("int")

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets that hold rows of ``df``, in order."""
        # At most ``buckets`` rows.
        return sorted(r[0] for r in df.select(self.bucket(df).alias(BUCKET)).distinct().collect())

    def folders(self, manifest: Manifest, buckets: Sequence[int] | None = None) -> list[str]:
        wanted = range(self.buckets) if buckets is None else buckets
        return [f"{self.path}/state/version={manifest.held[b]}/bucket={b}" for b in wanted if manifest.held[b] != NONE]

    def rewritten(self, version: int) -> list[int]:
        """The buckets that a version rewrote and left with rows."""
        return [b for b, v in enumerate(self.manifest(version).held) if v == version]

    def _stored(self, manifest: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        folders = self.folders(manifest, buckets)
        if not folders:
            return self.spark.createDataFrame([], manifest.columns)
        return self.spark.read.schema(manifest.columns).parquet(*folders)

    def _visible(self, df: DataFrame) -> DataFrame:
        return df.where(~F.coalesce(F.col(self.hidden), F.lit(False))).drop(self.hidden) if self.hidden else df

    def state(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows as of a version, by default the latest; of all buckets or of some."""
        manifest = self.manifest(version)
        if manifest is None:
            raise FileNotFoundError(f"{self.path}: no state yet" if version is None else f"{self.path}: version {version} cannot be read")
        return self._visible(self._stored(manifest, buckets))

    def state_at(self, moment: datetime.datetime) -> DataFrame:
        """The rows at a point in time."""
        version = self.version_at(moment)
        if version is None:
            raise FileNotFoundError(f"{self.path}: no version at {moment}")
        return self.state(version)

    def changes(self, start: int, end: int | None = None) -> DataFrame:
        """Changes of versions ``start`` to ``end`` (inclusive, by default the latest): the rows with ``_change_type``,
        ``_commit_version`` and ``_commit_timestamp``. Only the folders of these versions are read."""
        last = self.manifest()
        if last is None:
            raise FileNotFoundError(f"{self.path}: no state yet")
        logged = {int(n.removeprefix("version=")) for n in store.names(self.spark, f"{self.path}/changes") if n.startswith("version=")}
        wanted = [v for v in range(max(start, 1), min(last.version, end or last.version) + 1)]
        if missing := [v for v in wanted if v not in logged]:
            raise FileNotFoundError(f"{self.path}: changes of versions {missing[0]} to {missing[-1]} are gone")
        schema = self._feed_schema(last.columns)
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/changes/version={v}" for v in wanted])

    def _feed_schema(self, columns: StructType) -> StructType:
        own = [StructField(f.name, f.dataType) for f in columns.fields if f.name != self.hidden]
        return StructType([StructField(CHANGE, StringType()), *own]).add(VERSION, "long").add(TIME, "timestamp")

    # --- writing ------------------------------------------------------------------------------

    def commit(
        self,
        batch: DataFrame,
        step: Step,
        at: datetime.datetime,
        source: str | None = None,
        number: int | None = None,
        touched: Sequence[int] | None = None,
        marks: Mapping[str, int] | None = None,
    ) -> int:
        """Apply ``batch`` and return the version that holds it.

        ``step`` gets the previous rows of the touched buckets and the batch and returns their next rows, one per key.
        Touched are the buckets of the batch, or those given, which must hold the batch. A batch without given buckets is
        kept while it is applied; with them it is computed as often as the step uses it. ``marks`` are numbers of further
        sources to remember with the version.
        A ``source`` numbers its batches: one that is not newer than the last one committed changes nothing, so a batch
        may be repeated after a failure.
        """
        last = self.manifest() or Manifest(NONE, "", [NONE] * self.buckets, StructType().json())
        if source is not None and number is not None and last.sources.get(source, -1) >= number:
            return last.version
        placed = batch.withColumn(BUCKET, self.bucket(batch)).persist() if touched is None else batch
        try:
            # At most ``buckets`` rows.
            if touched is None:
                touched = sorted(r[0] for r in placed.select(BUCKET).distinct().collect())
            if not touched:
                return last.version
            version = last.version + 1
            before = self._stored(last, touched) if last.version else None
            after = step(before, placed.drop(BUCKET))
            folder = f"{self.path}/state/version={version}"
            # The rebalance hint gathers a bucket into files of a fitting size and splits a crowded one.
            kept = after.withColumn("bucket", self.bucket(after)).hint("rebalance", F.col("bucket"))
            kept.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(folder)
        finally:
            if placed is not batch:
                placed.unpersist()
        full = {int(n.removeprefix("bucket=")) for n in store.names(self.spark, folder) if n.startswith("bucket=")}
        if strays := full - set(touched):
            raise ValueError(f"the step returned rows of buckets {sorted(strays)}, which the batch does not touch")
        known = {f.name for f in after.schema.fields}
        columns = StructType([*after.schema.fields, *[f for f in last.columns.fields if f.name not in known]])
        held = [(version if b in full else NONE) if b in set(touched) else last.held[b] for b in range(self.buckets)]
        sources = last.sources | dict(marks or {}) | ({source: number} if source is not None and number is not None else {})
        manifest = Manifest(version, at.isoformat(), held, columns.json(), sources)
        if self.logged:
            self._log(last, manifest, touched, at)
        store.write_text(self.spark, f"{self.path}/manifest/{version}.json", json.dumps(asdict(manifest)))
        return version

    def _log(self, last: Manifest, manifest: Manifest, touched: list[int], at: datetime.datetime) -> None:
        """Write what the touched buckets gained, lost and changed."""
        after = self._visible(self._stored(manifest, touched))
        if self.folders(last, touched):
            before = self._stored(last, touched)
            known = set(before.columns)
            before = before.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in manifest.columns.fields if f.name not in known])
            feed = cdc.snapshot_diff(self._visible(before), after, self.keys)
        else:
            # Nothing was there, so every row is an insert, and none has to meet an earlier one.
            feed = after.select(F.lit("insert").alias(CHANGE), "*")
        stamped = feed.withColumns({VERSION: F.lit(manifest.version).cast("long"), TIME: F.lit(at).cast("timestamp")})
        stamped.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/changes/version={manifest.version}")

    def vacuum(self, keep: int = 2, changes: int | None = None) -> None:
        """Remove what the latest ``keep`` versions do not need; with ``changes``, also all but that many change folders.

        Older versions can then still be had from the log: see ``cdc.rewound``.
        """
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        needed = {(v, b) for m in kept for b, v in enumerate(m.held)}
        for version in versions[:-keep]:
            store.delete(self.spark, f"{self.path}/manifest/{version}.json")
        for name in store.names(self.spark, f"{self.path}/state"):
            version = int(name.removeprefix("version="))
            if version > versions[-1] or version == NONE:
                continue
            folder = f"{self.path}/state/{name}"
            buckets = [n for n in store.names(self.spark, folder) if n.startswith("bucket=")]
            spare = [n for n in buckets if (version, int(n.removeprefix("bucket="))) not in needed]
            for bucket in [""] if len(spare) == len(buckets) else spare:
                store.delete(self.spark, f"{folder}/{bucket}".rstrip("/"))
        if changes is not None:
            for name in store.names(self.spark, f"{self.path}/changes"):
                if int(name.removeprefix("version=")) <= versions[-1] - changes:
                    store.delete(self.spark, f"{self.path}/changes/{name}")


    def mark(self, source: str) -> int:
        """The number remembered for a source; 0 if there is none."""
        last = self.manifest()
        return last.sources.get(source, 0) if last else 0


def mirror(source: VersionedTable, target: VersionedTable, columns: Sequence[str], at: datetime.datetime) -> int:
    """Bring a copy of ``columns`` of a table, kept by other keys or in other buckets, up to date from its log.

    Rows without one of the copy's keys are not in the copy.
    """
    latest, start = source.versions()[-1:], target.mark("mirrored") + 1
    if not latest or latest[0] < start:
        return target.mark("mirrored")
    feed = source.changes(start, latest[0])
    # One version has one change of a key at most, so it is its own net change.
    net = cdc.net_changes(feed, source.keys) if start < latest[0] else feed.drop(VERSION, TIME)
    gone = ~F.col(CHANGE).isin("insert", "update_postimage")
    # Where both images have one key of the target, the image after the change stays.
    moved = net.select(*columns, gone.alias("_gone")).dropna(subset=target.keys)
    # The log can be read again, so the batch is not kept.
    touched = target.touched(moved) if start == latest[0] else None
    return target.commit(moved, replaced(target.keys, "_gone"), at, "mirrored", latest[0], touched=touched)


# --- steps ------------------------------------------------------------------------------------


def upserted(keys: Sequence[str]) -> Step:
    """Rows of the batch replace or join the rows of their keys."""

    def step(before: DataFrame | None, batch: DataFrame) -> DataFrame:
        if before is None:
            return batch
        return before.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch, allowMissingColumns=True)

    return step


def replaced(keys: Sequence[str], gone: str) -> Step:
    """As :func:`upserted`; rows whose boolean column ``gone`` is true only remove their key."""

    def step(before: DataFrame | None, batch: DataFrame) -> DataFrame:
        fresh = batch.where(~F.coalesce(F.col(gone), F.lit(False))).drop(gone)
        if before is None:
            return fresh
        return before.join(batch.select(*keys), list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)

    return step
