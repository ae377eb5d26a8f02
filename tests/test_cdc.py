from __future__ import annotations

import datetime
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan, rows, same
from tidewell.operators import cdc, scan

NOW = datetime.datetime(2024, 2, 1)
T = lambda day: datetime.datetime(2024, 1, day)
TABLE = "id int, v string, status string"
CHANGES = "id int, v string, status string, operation string, seq int"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", "new"), (2, "b", "new"), (3, None, "new"), (4, "d", "new")], TABLE)


def _merge(spark, target, changes, **options):
    batch = spark.createDataFrame(changes, CHANGES)
    return cdc.merge(target, batch, ["id"], ["v", "status"], NOW, sequence="seq", **options)


def test_merge_branches(spark, target):
    changes = [
        (1, "x", "up", "U", 1),  # matched update
        (2, None, None, "DELETE", 1),  # matched delete
        (3, "ignored", "ignored", "I", 1),  # matched insert: nothing
        (5, "e", "new", "INSERT", 1),  # unmatched insert
        (6, "f", "new", "U", 1),  # unmatched update: nothing
        (7, "g", "new", "D", 1),  # unmatched delete: nothing
        (8, "h", "new", "?", 1),  # unknown operation: nothing
    ]
    assert rows(_merge(spark, target, changes)) == [
        (1, "x", "up", None, NOW),
        (3, None, "new", None, None),
        (4, "d", "new", None, None),
        (5, "e", "new", NOW, NOW),
    ]
    soft = {r.id: r for r in _merge(spark, target, changes, delete="soft").collect()}
    assert set(soft) == {1, 2, 3, 4, 5}
    assert (soft[2].v, soft[2].status, soft[2]._is_deleted, soft[2]._deleted_at) == ("b", "deleted", True, NOW)
    assert (soft[5]._is_deleted, soft[5]._deleted_at, soft[4]._is_deleted) == (False, None, False)


def test_merge_combines_changes_of_one_key(spark, target):
    changes = [
        (5, "first", "s", "I", 1), (5, "second", "s", "U", 2),  # insert then update
        (6, "gone", "s", "I", 1), (6, None, None, "D", 2),  # insert then delete
        (1, None, None, "D", 1), (1, "again", "s", "I", 2),  # delete then insert
        (2, "late", "s", "U", 9), (2, "early", "s", "U", 3),  # out of order
    ]
    found = {r.id: r.v for r in _merge(spark, target, changes).collect()}
    assert found == {1: "again", 2: "late", 3: None, 4: "d", 5: "second"}


def _fold(known: bool, changes: list[tuple], soft: bool):
    """A row and its marks after single changes; None if there is none."""
    row = {"v": "a", "status": "new", "created": None, "touched": None, "marked": False} if known else None
    for value, operation, _ in sorted(changes, key=lambda c: c[2]):
        if operation == "I" and row is None:
            row = {"v": value, "status": "s", "created": NOW, "touched": NOW, "marked": False}
        elif operation == "U" and row is not None:
            row |= {"v": value, "status": "s", "touched": NOW}
        elif operation == "D" and row is not None:
            row = row | {"status": "deleted", "touched": NOW, "marked": True} if soft else None
    return row


def test_merge_equals_single_changes(spark):
    """Every sequence of up to four changes, for known and unknown keys."""
    runs = [s for n in range(5) for s in itertools.product("IUD", repeat=n)]
    target = spark.createDataFrame([(i, "a", "new") for i in range(len(runs))], TABLE)
    cases = {i + 1000 * (not known): (known, list(run)) for i, run in enumerate(runs) for known in (True, False)}
    batch = [(key, f"v{n}", "s", op, n) for key, (_, run) in cases.items() for n, op in enumerate(run)]
    random.Random(1).shuffle(batch)
    for soft in (False, True):
        found = {r.id: r for r in _merge(spark, target, batch, delete="soft" if soft else "hard").collect()}
        for key, (known, run) in cases.items():
            want = _fold(known, [(f"v{n}", op, n) for n, op in enumerate(run)], soft)
            assert (key in found) == (want is not None), run
            if want:
                row = found[key]
                assert (row.v, row.status, row._created_at, row._last_updated) == tuple(want[c] for c in ("v", "status", "created", "touched")), run
                assert not soft or (row._is_deleted, row._deleted_at is not None) == (want["marked"], want["marked"]), run
    loaded = {r.id: r.v for r in cdc.first_load(spark.createDataFrame(batch, CHANGES), ["id"], NOW, sequence="seq").collect()}
    folded = {k: _fold(False, [(f"v{n}", op, n) for n, op in enumerate(run)], False) for k, (_, run) in cases.items()}
    assert loaded == {k: row["v"] for k, row in folded.items() if row}


def test_update_leaves_the_mark_of_a_deleted_row(spark, target):
    once = _merge(spark, target, [(1, None, None, "D", 1)], delete="soft")
    again = spark.createDataFrame([(1, "x", "up", "U", 2), (2, "i", "s", "I", 3)], CHANGES)
    rows_ = {r.id: r for r in cdc.merge(once, again, ["id"], ["v", "status"], NOW, sequence="seq", delete="soft").collect()}
    assert (rows_[1].v, rows_[1].status, rows_[1]._is_deleted, rows_[1]._deleted_at) == ("x", "up", True, NOW)
    assert (rows_[2].v, rows_[2]._is_deleted) == ("b", False)


def test_empty_batch_changes_nothing(spark, target):
    merged = _merge(spark, target, [])
    assert same(merged.select("id", "v", "status"), target)
    assert merged.where("_last_updated IS NOT NULL").isEmpty()


def test_second_merge_keeps_creation_time(spark, target):
    once = _merge(spark, target, [(5, "e", "new", "I", 1)])
    batch = spark.createDataFrame([(5, "f", "up", "U", 2)], CHANGES)
    later = datetime.datetime(2024, 3, 1)
    row = cdc.merge(once, batch, ["id"], ["v", "status"], later, sequence="seq").where("id = 5").first()
    assert (row.v, row._created_at, row._last_updated) == ("f", NOW, later)


def test_first_load_takes_inserts(spark):
    batch = spark.createDataFrame([(1, "a", "s", "I", 1), (2, "b", "s", "U", 1), (3, "c", "s", "I", 1), (3, None, None, "D", 2)], CHANGES)
    loaded = cdc.first_load(batch, ["id"], NOW, sequence="seq")
    assert [(r.id, r.v, r._created_at) for r in loaded.collect()] == [(1, "a", NOW)]


def test_upsert(spark, target):
    source = spark.createDataFrame([(1, "z", "n", 5), (9, "y", "n", 6)], TABLE + ", extra int")
    assert rows(cdc.upsert(target, source, ["id"]).where("id IN (1, 2, 9)")) == [
        (1, "z", "n", 5), (2, "b", "new", None), (9, "y", "n", 6),
    ]


table_rows = st.dictionaries(st.integers(0, 8), st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([None, "x"])), max_size=9)


@settings(max_examples=6, deadline=None)
@given(table_rows, table_rows)
def test_feed_turns_before_into_after(spark, before, after):
    old = spark.createDataFrame([(k, *v) for k, v in before.items()], TABLE)
    new = spark.createDataFrame([(k, *v) for k, v in after.items()], TABLE)
    feed = cdc.snapshot_diff(old, new, ["id"])
    assert same(cdc.apply_feed(old, feed, ["id"]), new)
    kinds = {r._change_type: r["count"] for r in feed.groupBy("_change_type").count().collect()}
    changed = sum(before[k] != after[k] for k in before.keys() & after.keys())
    assert kinds.get("insert", 0) == len(after.keys() - before.keys())
    assert kinds.get("delete", 0) == len(before.keys() - after.keys())
    assert kinds.get("update_preimage", 0) == kinds.get("update_postimage", 0) == changed


EVENTS = "id int, seq timestamp, v string, operation string"


def _brute_history(events):
    """Plain-Python twin of scd2 for small inputs."""
    found = []
    for key in {e[0] for e in events}:
        mine, current = sorted((e for e in events if e[0] == key), key=lambda e: e[1]), None
        version = 0
        for _, seq, v, operation in mine:
            gone = operation == "DELETE"
            if current is not None and (gone or v != current[0]):
                found.append((key, current[0], current[1], seq, False, current[2]))
                current = None
            if not gone and current is None:
                version += 1
                current = (v, seq, version)
        if current is not None:
            found.append((key, current[0], current[1], None, True, current[2]))
    return sorted(found, key=repr)


events = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 28), st.sampled_from(["a", "b", None]), st.sampled_from(["INSERT", "UPDATE", "DELETE"])),
    max_size=40,
    unique_by=lambda e: (e[0], e[1]),
)


@settings(max_examples=6, deadline=None)
@given(events, st.integers(1, 12))
def test_history_matches_brute_force_on_both_routes(spark, made, split_rows):
    made = [(k, T(d), v, o) for k, d, v, o in made]
    df = spark.createDataFrame(made, EVENTS).repartition(3)
    arguments = (df, ["id"], "seq", ["v"], "operation = 'DELETE'")
    assert rows(cdc.scd2(*arguments)) == _brute_history(made)
    split = cdc.scd2(*arguments, split_rows=split_rows)
    assert rows(split) == _brute_history(made)
    current = split.where("is_current").select("id", "v")
    assert same(current, cdc.scd1(df, ["id"], "seq", "operation = 'DELETE'").select("id", "v"))


def test_history_of_one_crowded_key(spark):
    """A key with half of all events, in bursts, against the plain route."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("id"),
        F.timestamp_micros(F.when(F.col("id") < 3000, F.col("id")).otherwise(F.col("id") * 1000)).alias("seq"),
        (F.col("id") % 7).cast("string").alias("v"),
        F.when(F.col("id") % 11 == 0, "DELETE").otherwise("UPDATE").alias("operation"),
    )
    arguments = (df, ["id"], "seq", ["v"], "operation = 'DELETE'")
    assert same(cdc.scd2(*arguments), cdc.scd2(*arguments, split_rows=100))


def test_bursts_are_spread(spark):
    """Nearly all events of the key lie close together, and no partition of the scan holds much more than its share."""
    burst = F.when(F.col("id") == 0, 10**12).otherwise(F.col("id"))
    df = spark.range(5000).select(F.lit(1).alias("id"), burst.alias("seq"), (F.col("id") % 3).alias("v"))
    placed = scan.laid_out(df, ["id"], [F.col("seq")], parts=10)
    assert placed.groupBy("_slot").count().agg(F.max("count")).first()[0] < 1_500
    numbered = scan.with_running(placed, ["id"], {"n": F.lit(1)})
    assert numbered.where("n != IF(seq = 1000000000000, 5000, seq)").isEmpty()


def test_repeated_event_counts_once(spark):
    df = spark.createDataFrame([(1, T(1), "a", "INSERT")] * 3 + [(1, T(2), "a", "UPDATE"), (1, T(3), "b", "UPDATE")], EVENTS)
    assert rows(cdc.scd2(df, ["id"], "seq", ["v"], "operation = 'DELETE'")) == [
        (1, "a", T(1), T(3), False, 1),
        (1, "b", T(3), None, True, 2),
    ]


def test_history_update_rebuilds_only_the_keys_of_the_batch(spark):
    old = [(1, T(1), "a", "INSERT"), (1, T(9), "b", "UPDATE"), (2, T(1), "x", "INSERT"), (3, T(1), "y", "INSERT")]
    new = [(1, T(5), "late", "UPDATE"), (3, T(7), None, "DELETE"), (4, T(2), "z", "INSERT")]
    before, batch = spark.createDataFrame(old, EVENTS), spark.createDataFrame(new, EVENTS)
    rest = (["id"], "seq", ["v"], "operation = 'DELETE'")
    marked = cdc.scd2(before, *rest).withColumn("v", F.when(F.col("id") == 2, "taken over").otherwise(F.col("v")))
    updated = cdc.scd2_update(marked, before, batch, *rest)
    assert same(updated.where("id != 2"), cdc.scd2(before.unionAll(batch), *rest).where("id != 2"))
    assert [r.v for r in updated.where("id = 2").collect()] == ["taken over"]


def test_small_batches_do_not_move_the_target(spark):
    big = spark.range(1000).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("v"), F.lit("s").alias("status"))
    batch = spark.createDataFrame([(5, "x", "s", "U", 1), (5000, "n", "s", "I", 1)], CHANGES)
    text = plan(cdc.merge(big, batch, ["id"], ["v", "status"], NOW, sequence="seq"))
    assert text.count("BroadcastHashJoin") >= 2 and "Exchange hashpartitioning" not in text.split("Union")[0]
    first = text[: text.index("LeftSemi")] if "LeftSemi" in text else text
    assert "SortMergeJoin" not in first


def test_scd1_ignores_arrival_order(spark):
    made = [(1, T(5), "late", "UPDATE"), (1, T(2), "early", "INSERT"), (2, T(1), "x", "INSERT"), (2, T(3), None, "DELETE")]
    found = cdc.scd1(spark.createDataFrame(made, EVENTS), ["id"], "seq", "operation = 'DELETE'", exclude=["operation"])
    assert rows(found) == [(1, T(5), "late")]


def test_snapshot_merge_versions(spark):
    def snapshot(*pairs):
        return spark.createDataFrame(pairs, "id int, v string")

    first = snapshot((1, "a"), (2, None), (3, "c"))
    history = cdc.scd2_merge(cdc.empty_history(first, ["id"], ["v"]), first, ["id"], ["v"], T(1))
    assert rows(history.select("id", "version", "is_current")) == [(1, 1, True), (2, 1, True), (3, 1, True)]
    history = cdc.scd2_merge(history, snapshot((1, "b"), (2, None), (4, "d")), ["id"], ["v"], T(2), close_missing=True)
    assert rows(history) == [
        (1, "a", T(1), T(2), False, 1), (1, "b", T(2), None, True, 2), (2, None, T(1), None, True, 1),
        (3, "c", T(1), T(2), False, 1), (4, "d", T(2), None, True, 1),
    ]
    history = cdc.scd2_merge(history, snapshot((3, "c")), ["id"], ["v"], T(3))
    back = history.where("id = 3 AND is_current").first()
    assert (back.version, back.valid_from) == (2, T(3))
    assert history.where("is_current").count() == 4
    same_again = cdc.scd2_merge(history, snapshot((3, "c")), ["id"], ["v"], T(4))
    assert same(history, same_again)


def test_as_of_bounds(spark):
    df = spark.createDataFrame([(1, T(1), T(5)), (1, T(5), None)], "id int, valid_from timestamp, valid_to timestamp")
    assert [r.valid_from for r in cdc.as_of(df, T(5)).collect()] == [T(5)]
    assert cdc.as_of(df, datetime.datetime(2023, 12, 31)).isEmpty()


def test_classification_and_audit(spark):
    df = spark.createDataFrame([(1, "INSERT", T(1)), (2, "u", T(2)), (3, "DELETE", T(3)), (4, None, T(4))], "id int, operation string, updated_at timestamp")
    found = cdc.classify_changes(df).select("change_type", "is_deleted")
    assert [tuple(r) for r in found.collect()] == [
        ("new_order", False), ("status_change", False), ("cancellation", True), ("unknown", False),
    ]
    trail = cdc.audit_trail({"a": (df, "id"), "b": (df, "id")})
    assert trail.count() == 8 and trail.columns == ["table_name", "record_id", "operation", "change_timestamp"]
