"""Change data capture on plain tables: merges, change feeds, SCD type 1 and 2, point in time.

Each operator returns the next state as a DataFrame; the caller writes it to a new directory.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import labels
from tidewell.operators import ordered, scan
from tidewell.operators.ordered import SPLIT_ROWS, latest_per_key
from tidewell.operators.skew import fits_broadcast
from tidewell.session import durable, stored


def _moment(at: datetime.datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def _differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe inequality of two rows of columns."""
    return reduce(Column.__or__, [~a.eqNullSafe(b) for a, b in zip(left, right)], F.lit(False))


# --- merge ------------------------------------------------------------------------------------


def _in_order(changes: DataFrame, keys: Sequence[str], sequence: str | None) -> DataFrame:
    """Changes with a known operation (I, U or D) as ``keys``, ``operation`` and ``_row``: all columns but the keys,
    the sequence first, so that rows compare in the order in which they are applied. Ties go by all columns."""
    code = labels.operation_code(F.col("operation"))
    coded = changes.withColumn("operation", code).where(code.isNotNull())
    names = [c for c in [sequence] if c]
    names += [c for c in coded.columns if c not in [*keys, *names]]
    return coded.select(*keys, "operation", F.struct(*names).alias("_row"))


def _extreme(operation: str, pick: str) -> Column:
    """First or last row of an operation, as an aggregate that combines on the map side."""
    own = F.when(F.col("operation") == operation, F.col("_row"))
    return F.min(own) if pick == "first" else F.max(own)


def _effects(changes: DataFrame, keys: Sequence[str], sequence: str | None, soft: bool) -> DataFrame:
    """One row per key: what its changes come to if they are applied one by one.

    ``_insert`` is the insert that brings the row into being, if the target has none at that point; ``_update`` the
    last update of a present row, ``_delete`` the last delete. With hard deletes only what follows the last delete
    counts; with soft deletes the row stays, and the first insert of an unknown key is the one that counts.
    """
    rows = _in_order(changes, keys, sequence)
    if not soft:
        rows = durable(rows)
        deleted = rows.where("operation = 'D'").groupBy(*keys).agg(F.max("_row").alias("_gone"))
        same_key = reduce(Column.__and__, [F.col(f"r.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys])
        after = rows.alias("r").join(deleted.alias("d"), same_key, "left").select("r.*", "_gone")
        rows = after.where("_gone IS NULL OR operation = 'D' OR _row > _gone")
    found = {"_insert": _extreme("I", "first"), "_update": _extreme("U", "last"), "_delete": _extreme("D", "last")}
    return rows.groupBy(*keys).agg(*[v.alias(c) for c, v in found.items()])


def merge(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    now: datetime.datetime | Column,
    sequence: str | None = None,
    delete: str = "hard",
) -> DataFrame:
    """Apply inserts, updates and deletes (``operation`` I/U/D) to ``target``, as if one by one in order.

    A D on a present row removes it (``delete="hard"``) or marks it (``"soft"``: status ``deleted``, ``_is_deleted``,
    ``_deleted_at``); a U on a present row replaces the ``update`` columns; an I of an absent key inserts. All others
    change nothing. A marked row is still present: a U replaces its columns and leaves the mark, an I is ignored.

    The result has the target's columns plus ``_created_at``, ``_last_updated`` and, for soft deletes, ``_is_deleted``
    and ``_deleted_at``. A row that is deleted and inserted again is a new row. The changes come down to one row per
    key by aggregates; that batch is materialised and measured, and a small one is broadcast, so that the target is
    read but not shuffled.
    """
    soft = delete == "soft"
    moment = _moment(now).cast("timestamp")
    extra = {"_created_at": "timestamp", "_last_updated": "timestamp"}
    if soft:
        extra |= {"_is_deleted": "boolean", "_deleted_at": "timestamp"}
    present = target.withColumns({c: F.lit(None).cast(k) for c, k in extra.items() if c not in target.columns})
    batch = durable(_effects(changes, keys, sequence, soft))
    small = fits_broadcast(batch.select(*keys, "_insert", "_update"))

    def nearby(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    # Rows of the target. With a small batch they are not moved.
    deleted = F.col("_delete").isNotNull()
    reborn = deleted & F.col("_insert").isNotNull() & F.lit(not soft)
    removed = deleted & ~reborn & F.lit(not soft)
    marked = deleted & F.lit(soft)
    updated = F.col("_update").isNotNull()
    newest = F.when(reborn & (F.col("_update").isNull() | (F.col("_update") < F.col("_insert"))), F.col("_insert")).otherwise(F.col("_update"))
    columns: dict[str, Column] = {c: F.col(c) if c in keys else F.when(~reborn, F.col(c)) for c in present.columns}
    columns |= {c: F.when(reborn | updated, newest[c]).otherwise(F.col(c)) for c in update}
    columns["_created_at"] = F.when(reborn, moment).otherwise(F.col("_created_at"))
    columns["_last_updated"] = F.when(reborn | updated | marked, moment).otherwise(F.col("_last_updated"))
    if soft:
        if "status" in columns:
            last = marked & F.coalesce(F.col("_delete") > F.col("_update"), F.lit(True))
            columns["status"] = F.when(last, F.lit("deleted")).otherwise(columns["status"])
        columns["_is_deleted"] = marked | F.coalesce("_is_deleted", F.lit(False))
        columns["_deleted_at"] = F.when(marked, moment).otherwise(F.col("_deleted_at"))
    matched = present.join(nearby(batch), list(keys), "left")
    kept = (matched if soft else matched.where(~removed)).select(*[v.alias(n) for n, v in columns.items()])

    # Rows of the batch whose key the target does not have.
    known = target.select(*keys).join(nearby(batch.select(*keys)), list(keys), "left_semi")
    begun = F.col("_insert")
    later = F.coalesce(F.col("_update") > begun, F.lit(False))
    values = F.when(later, F.col("_update")).otherwise(begun)
    fresh: dict[str, Column] = {k: F.col(k) for k in keys}
    fresh |= {c: values[c] for c in update}
    fresh |= {"_created_at": moment, "_last_updated": moment}
    if soft:
        gone = F.coalesce(F.col("_delete") > begun, F.lit(False))
        fresh |= {"_is_deleted": gone, "_deleted_at": F.when(gone, moment)}
        if "status" in present.columns:
            last = gone & (~later | F.coalesce(F.col("_delete") > F.col("_update"), F.lit(True)))
            fresh["status"] = F.when(last, F.lit("deleted")).otherwise(fresh.get("status", F.lit(None).cast("string")))
    rest = {f.name: F.lit(None).cast(f.dataType) for f in present.schema.fields}
    arriving = batch.where("_insert IS NOT NULL")
    inserted = arriving.join(known, list(keys), "left_anti").select(*[v.alias(n) for n, v in (rest | fresh).items()])
    return kept.unionByName(inserted)


def first_load(changes: DataFrame, keys: Sequence[str], now: datetime.datetime | Column, sequence: str | None = None) -> DataFrame:
    """Initial table from a change batch: what its changes leave if they are applied one by one to nothing."""
    batch = _effects(changes, keys, sequence, soft=False).where("_insert IS NOT NULL")
    later = F.coalesce(F.col("_update") > F.col("_insert"), F.lit(False))
    row = F.when(later, F.col("_update")).otherwise(F.col("_insert"))
    moment = _moment(now).cast("timestamp")
    names = [c for c in changes.columns if c not in [*keys, "operation"]]
    loaded = batch.select(*keys, *[row[c].alias(c) for c in names])
    return loaded.withColumns({"_created_at": moment, "_last_updated": moment})


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All source rows plus the target rows whose key the source does not have.

    ``source`` must hold one row per key (see ``latest_per_key``).
    """
    arriving = durable(source.select(*keys))
    side = F.broadcast(arriving) if fits_broadcast(arriving) else arriving
    untouched = target.join(side, list(keys), "left_anti")
    return untouched.unionByName(source, allowMissingColumns=True)


# --- change feed ------------------------------------------------------------------------------


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes between two snapshots with ``_change_type`` insert, delete, update_preimage or
    update_postimage. Comparison is null-safe."""
    columns = before.columns
    values = [c for c in columns if c not in keys]
    left = before.select(*keys, F.struct(*columns).alias("_before"))
    right = after.select(*keys, F.struct(*columns).alias("_after"))
    both = left.join(right, list(keys), "full_outer")
    old, new = F.col("_before"), F.col("_after")
    changed = _differs([old[c] for c in values], [new[c] for c in values])

    # Only the kinds are multiplied, and a row is taken as it is: building both images of every row costs more than the join.
    kinds = (
        F.when(old.isNull(), F.array(F.lit("insert")))
        .when(new.isNull(), F.array(F.lit("delete")))
        .when(changed, F.array(F.lit("update_preimage"), F.lit("update_postimage")))
    )
    events = both.select(old, new, kinds.alias("_kinds")).where(F.col("_kinds").isNotNull()).select(old, new, F.explode("_kinds").alias("_change_type"))
    image = F.when(F.col("_change_type").isin("delete", "update_preimage"), old).otherwise(new)
    return events.select("_change_type", image.alias("_image")).select("_change_type", *[F.col("_image")[c].alias(c) for c in columns])


def apply_feed(before: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after a change feed: the inverse of :func:`snapshot_diff`."""
    gone = durable(feed.select(*keys).distinct())
    side = F.broadcast(gone) if fits_broadcast(gone) else gone
    fresh = feed.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    return before.join(side, list(keys), "left_anti").unionByName(fresh)


def _ends(feed: DataFrame, keys: Sequence[str], sequence: str, rows: Sequence[str]) -> DataFrame:
    """One row per key of a feed over several versions: ``_before`` its first change and ``_after`` its last one (NULL
    where there is no row). Two aggregates that combine on the map side; no key gathers its changes."""
    after = F.col("_change_type").isin("insert", "update_postimage")
    # Within a version the image before comes first. Struct order ends in the row itself, so ties are settled.
    event = F.struct(F.col(sequence).alias("at"), after.alias("after"), F.struct(*rows).alias("row"))
    ends = feed.groupBy(*keys).agg(F.min(event).alias("first"), F.max(event).alias("last"))
    return ends.select(
        *keys,
        F.when(~F.col("first.after"), F.col("first.row")).alias("_before"),
        F.when(F.col("last.after"), F.col("last.row")).alias("_after"),
    )


def net_changes(feed: DataFrame, keys: Sequence[str], sequence: str = "_commit_version") -> DataFrame:
    """What a feed over several versions comes to: at most one insert, delete, or pair of images per key.

    A key that is inserted and deleted again, or ends with the values it began with, has no net change. Columns: the
    feed's without ``sequence`` and ``_commit_timestamp``.
    """
    rows = [c for c in feed.columns if c not in ("_change_type", "_commit_timestamp", sequence)]
    ends = _ends(feed, keys, sequence, rows)
    old, new = F.col("_before"), F.col("_after")

    def event(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), *[row[c].alias(c) for c in rows])

    events = (
        F.when(old.isNull() & new.isNotNull(), F.array(event("insert", new)))
        .when(old.isNotNull() & new.isNull(), F.array(event("delete", old)))
        .when(~old.eqNullSafe(new), F.array(event("update_preimage", old), event("update_postimage", new)))
    )
    return ends.select(events.alias("_events")).where(F.col("_events").isNotNull()).select(F.inline("_events"))


def rewound(after: DataFrame, feed: DataFrame, keys: Sequence[str], sequence: str = "_commit_version") -> DataFrame:
    """The rows before the first change of ``feed``, from the rows after its last one: keys the feed does not name are
    taken as they are, the others go back to the image before their first change."""
    ends = _ends(feed, keys, sequence, after.columns)
    untouched = after.join(ends.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(ends.where(F.col("_before").isNotNull()).select("_before.*"))


# --- SCD --------------------------------------------------------------------------------------


def _sequenced(events: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """One event per key and sequence value, ties broken by all columns."""
    order = ordered.all_columns_order(events, skip=[*keys, sequence])
    return latest_per_key(events, [*keys, sequence], order or [F.lit(1)])


def scd1(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    is_delete: str | Column,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Current state: the event with the greatest sequence per key, unless it is a delete.

    The order of arrival does not matter. Ties are broken by all columns.
    """
    gone = F.expr(is_delete) if isinstance(is_delete, str) else is_delete
    flagged = events.withColumn("_gone", F.coalesce(gone, F.lit(False)))
    order = [F.desc_nulls_last(sequence), *ordered.all_columns_order(events, skip=[*keys, sequence])]
    return latest_per_key(flagged, keys, order).where(~F.col("_gone")).drop("_gone", *exclude)


def scd2(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    is_delete: str | Column,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """History: one row per key and period of constant tracked values.

    An event that repeats the values before it opens nothing; a delete closes the open row and
    opens nothing. Columns: keys, tracked, ``valid_from``, ``valid_to``, ``is_current``,
    ``version``. A key may hold any share of the events: if one has more than ``split_rows``, the history comes from an
    ordered scan (:mod:`tidewell.operators.scan`) instead of windows by key.
    """
    gone = F.expr(is_delete) if isinstance(is_delete, str) else is_delete
    plain = events.withColumn("_gone", F.coalesce(gone, F.lit(False))).select(*keys, sequence, *tracked, "_gone")
    single = _sequenced(plain, keys, sequence)
    was, next_ = F.col("_was"), F.col("_next")
    values_moved = _differs([F.col(c) for c in tracked], [was[c] for c in tracked])
    opens = ~F.col("_gone") & (was.isNull() | was["_gone"] | values_moved)
    closes = F.col("_gone") & was.isNotNull() & ~was["_gone"]
    # A boundary either opens or closes a period. After this filter a close is always preceded by
    # the open it ends.
    boundary = opens | closes
    crowded = plain.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > split_rows).limit(1)
    if crowded.isEmpty():
        along = W.partitionBy(*keys).orderBy(sequence)
        bounds = single.withColumn("_was", F.lag(F.struct(*tracked, "_gone")).over(along)).where(boundary).drop("_was")
        ended = bounds.withColumn("_next", F.lead(F.struct(sequence)).over(along)).where(~F.col("_gone"))
        numbered = ended.withColumn("version", F.row_number().over(along))
    else:
        placed = scan.laid_out(single, keys, [F.col(sequence)])
        bounds = stored(scan.with_neighbour(placed, keys, [*tracked, "_gone"], "_was").where(boundary).drop("_was"))
        counted = scan.with_running(bounds, keys, {"version": F.when(F.col("_gone"), 0).otherwise(1)})
        numbered = scan.with_neighbour(counted, keys, [sequence], "_next", ahead=True, base=bounds).where(~F.col("_gone"))
    return numbered.select(
        *keys,
        *tracked,
        F.col(sequence).alias("valid_from"),
        next_[sequence].alias("valid_to"),
        next_[sequence].isNull().alias("is_current"),
        F.col("version").cast("int").alias("version"),
    )


def scd2_update(
    history: DataFrame,
    events: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    is_delete: str | Column,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Next history after a batch of events that may be late: only the batch's keys are rebuilt,
    from all their ``events`` so far and the batch; the rows of other keys are taken over."""
    affected = durable(batch.select(*keys).distinct())
    side = F.broadcast(affected) if fits_broadcast(affected) else affected
    untouched = history.join(side, list(keys), "left_anti")
    earlier = events.join(side, list(keys), "left_semi")
    rebuilt = scd2(earlier.unionByName(batch), keys, sequence, tracked, is_delete, split_rows)
    return untouched.unionByName(rebuilt)


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    now: datetime.datetime | Column,
    close_missing: bool = False,
) -> DataFrame:
    """Next history after a snapshot: changed rows are closed and get a new version, new keys open
    version 1 (or the next one, if the key existed before), everything else stays.

    ``close_missing`` also closes current rows whose key the snapshot no longer has. Works on an
    empty history, so the first load needs no branch. One current row per key is expected, and
    ``snapshot`` must hold one row per key.
    """
    moment = _moment(now).cast(dict(history.dtypes)["valid_from"])
    columns = [*keys, *tracked, "valid_from", "valid_to", "is_current", "version"]
    past = history.where(~F.col("is_current")).select(*columns)
    current = history.where("is_current").select(*keys, F.struct(*columns).alias("_old"))
    arriving = snapshot.select(*keys, F.struct(*tracked).alias("_new"))
    last = history.groupBy(*keys).agg(F.max("version").alias("_last"))
    both = current.join(arriving, list(keys), "full_outer").join(last, list(keys), "left")

    old, new = F.col("_old"), F.col("_new")
    changed = _differs([old[c] for c in tracked], [new[c] for c in tracked])

    def version(source: dict[str, Column]) -> Column:
        return F.struct(*[source[c].alias(c) for c in columns])

    same = {k: F.col(k) for k in keys} | {c: old[c] for c in columns if c not in keys}
    closed = same | {"valid_to": moment, "is_current": F.lit(False)}
    opened = {k: F.col(k) for k in keys} | {c: new[c] for c in tracked}
    opened |= {
        "valid_from": moment,
        "valid_to": F.lit(None).cast(dict(history.dtypes)["valid_to"]),
        "is_current": F.lit(True),
        "version": (F.coalesce("_last", F.lit(0)) + 1).cast("int"),
    }
    gone = closed if close_missing else same
    rows = (
        F.when(old.isNull(), F.array(version(opened)))
        .when(new.isNull(), F.array(version(gone)))
        .when(changed, F.array(version(closed), version(opened)))
        .otherwise(F.array(version(same)))
    )
    return past.unionByName(both.select(F.inline(rows)))


def empty_history(snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """A history without rows, shaped for :func:`scd2_merge`."""
    return snapshot.where(F.lit(False)).select(
        *keys,
        *tracked,
        F.lit(None).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(0).alias("version"),
    )


def as_of(history: DataFrame, moment: datetime.datetime | Column) -> DataFrame:
    """Rows of a history that were valid at ``moment``; the start belongs to a period, the end does not."""
    at = _moment(moment)
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


# --- change reporting -------------------------------------------------------------------------


def classify_changes(events: DataFrame) -> DataFrame:
    """``change_type`` and ``is_deleted`` from the operation, in either spelling."""
    code = labels.operation_code(F.col("operation"))
    return events.withColumns(
        {
            "change_type": labels.lookup(code, labels.CHANGE_TYPES, "unknown"),
            "is_deleted": F.coalesce(code == "D", F.lit(False)),
        }
    )


def audit_trail(feeds: Mapping[str, tuple[DataFrame, str]], sequence: str = "updated_at") -> DataFrame:
    """All changes of several tables: ``{table name: (events, key column)}``."""
    parts = [
        events.select(
            F.lit(table).alias("table_name"),
            F.col(key).cast("string").alias("record_id"),
            "operation",
            F.col(sequence).alias("change_timestamp"),
        )
        for table, (events, key) in feeds.items()
    ]
    return reduce(DataFrame.unionByName, parts)
