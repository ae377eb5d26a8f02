from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell.operators import cdc
from tidewell.sinks import store
from tidewell.sinks.versions import VersionedTable, mirror, replaced, upserted
from tidewell.streaming import incremental

T = lambda day: datetime.datetime(2024, 1, day, tzinfo=datetime.timezone.utc)
SCHEMA = "id int, v string, seq int"


def _table(spark, tmp_path, **options):
    return VersionedTable(spark, str(tmp_path / "t"), ["id"], **({"buckets": 8} | options))


def _frame(spark, *made):
    return spark.createDataFrame(list(made), SCHEMA)


def test_versions_and_ranges_of_changes(spark, tmp_path):
    table = _table(spark, tmp_path)
    step = upserted(["id"])
    assert table.commit(_frame(spark, *[(i, "a", 1) for i in range(40)]), step, T(1)) == 1
    assert table.commit(_frame(spark, (3, "b", 2), (50, "n", 2)), step, T(5)) == 2
    assert table.commit(_frame(spark, (3, "c", 3)), step, T(9)) == 3
    assert table.versions() == [1, 2, 3]
    assert table.state(1).count() == 40 and rows(table.state(2).where("id IN (3, 50)")) == [(3, "b", 2), (50, "n", 2)]
    assert rows(table.changes(2, 2).select("_change_type", "id", "v")) == [
        ("insert", 50, "n"), ("update_postimage", 3, "b"), ("update_preimage", 3, "a"),
    ]
    assert rows(table.changes(2).groupBy("_commit_version").count()) == [(2, 3), (3, 2)]
    assert rows(cdc.net_changes(table.changes(2).where("id = 3"), ["id"]).select("_change_type", "v")) == [
        ("update_postimage", "c"), ("update_preimage", "a"),
    ]
    assert table.changes(4).isEmpty() and table.changes(1).columns == ["_change_type", "id", "v", "seq", "_commit_version", "_commit_timestamp"]
    # A range is read from its own folders.
    assert all("/changes/version=3/" in f for f in table.changes(3).inputFiles())
    assert same(table.state_at(T(6).replace(tzinfo=None)), table.state(2)) and same(table.state(), table.state(3))
    assert [r.buckets for r in table.history().orderBy("version").collect()][1:] == [len({b for b in table.rewritten(2)}), 1]
    with pytest.raises(FileNotFoundError):
        table.state_at(datetime.datetime(2023, 1, 1))


def test_rows_in_empty_buckets_are_logged_without_a_join(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path, hidden="gone")
    made = spark.createDataFrame([(1, "a", False), (2, None, None), (3, "c", True)], "id int, v string, gone boolean")
    bucket = {r.id: r.b for r in made.select("id", table.bucket(made).alias("b")).collect()}
    other = next(r.id for r in spark.range(4, 99).selectExpr("int(id) AS id").withColumn("b", table.bucket(made)).collect() if r.b not in bucket.values())
    with monkeypatch.context() as patched:
        patched.setattr(cdc, "snapshot_diff", lambda *_: pytest.fail("nothing to compare with"))
        table.commit(made, upserted(["id"]), T(1))
        table.commit(spark.createDataFrame([(other, "n", False)], made.schema), upserted(["id"]), T(2))
    table.commit(spark.createDataFrame([(1, "b", False)], made.schema), upserted(["id"]), T(3))
    assert rows(table.changes(1).select("_commit_version", "_change_type", "id", "v")) == [
        (1, "insert", 1, "a"), (1, "insert", 2, None), (2, "insert", other, "n"), (3, "update_postimage", 1, "b"), (3, "update_preimage", 1, "a"),
    ]


def test_a_copy_takes_one_version_as_it_is_logged(spark, tmp_path, monkeypatch):
    """The log of one version needs no netting, which would deal and sort all of its rows; several versions do."""
    source = _table(spark, tmp_path)
    target = VersionedTable(spark, str(tmp_path / "copy"), ["id", "v"], 4, ["v"])
    step = replaced(["id"], "gone")
    batch = lambda *made: spark.createDataFrame(list(made), SCHEMA + ", gone boolean")
    copied = lambda: rows(target.state().select("id", "v", "seq"))
    with monkeypatch.context() as patched:
        patched.setattr(cdc, "net_changes", lambda *_: pytest.fail("one version is net"))
        source.commit(batch((1, "a", 1, False), (2, "b", 1, False), (3, None, 1, False)), step, T(1))
        assert mirror(source, target, ["id", "v", "seq"], T(1)) == 1 and copied() == [(1, "a", 1), (2, "b", 1)]
        source.commit(batch((1, "a", 2, False), (2, "c", 2, False), (3, "d", 2, False)), step, T(2))
        assert mirror(source, target, ["id", "v", "seq"], T(2)) == 2 and copied() == [(1, "a", 2), (2, "c", 2), (3, "d", 2)]
    source.commit(batch((1, "e", 3, False), (3, "d", 2, True)), step, T(3))
    source.commit(batch((1, "a", 4, False), (5, "f", 4, False)), step, T(4))
    mirror(source, target, ["id", "v", "seq"], T(4))
    assert copied() == [(1, "a", 4), (2, "c", 2), (5, "f", 4)]


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    table = _table(spark, tmp_path, buckets=16)
    table.commit(_frame(spark, *[(i, "a", 1) for i in range(200)]), upserted(["id"]), T(1))
    seen = []

    def watched(before, batch):
        seen.extend(before.inputFiles())
        return upserted(["id"])(before, batch)

    table.commit(_frame(spark, (7, "b", 2)), watched, T(2))
    touched = table.rewritten(2)
    assert len(touched) == 1 and {f.split("bucket=")[1].split("/")[0] for f in seen} == {str(touched[0])}
    assert [v for b, v in enumerate(table.manifest().held) if b not in touched] == [1] * 15
    assert table.state().count() == 200 and rows(table.state(buckets=touched).where("id = 7")) == [(7, "b", 2)]


def test_repeats_and_failures_change_nothing(spark, tmp_path):
    table = _table(spark, tmp_path)
    step = replaced(["id"], "gone")
    batch = lambda *made: spark.createDataFrame(list(made), SCHEMA + ", gone boolean")
    table.commit(batch((1, "a", 1, False), (2, "a", 1, None)), step, T(1), "s", 0)
    table.commit(batch((1, "b", 2, False)), step, T(2), "s", 1)
    assert table.commit(batch((1, "again", 2, False)), step, T(3), "s", 1) == 2
    assert table.commit(batch((1, "other", 2, False)), step, T(3), "other", 0) == 3
    assert table.commit(batch().where("false"), step, T(3), "s", 2) == 3

    def failing(before, fresh):
        before.write.parquet(f"{table.path}/state/version=4/bucket=0")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        table.commit(batch((1, "c", 3, False)), failing, T(4), "s", 3)
    assert rows(table.state()) == [(1, "other", 2), (2, "a", 1)]
    assert table.commit(batch((1, "c", 3, False), (2, None, 3, True)), step, T(4), "s", 3) == 4
    assert rows(table.state()) == [(1, "c", 3)]
    # All rows may go; the table is then empty, not missing.
    table.commit(batch((1, None, 4, True)), step, T(5), "s", 4)
    assert table.state().isEmpty() and table.state().columns == ["id", "v", "seq"]
    table.commit(batch((9, "z", 5, False)), step, T(6), "s", 5)
    assert rows(table.state()) == [(9, "z", 5)]


def test_step_may_not_leave_its_buckets(spark, tmp_path):
    table = _table(spark, tmp_path)
    with pytest.raises(ValueError, match="does not touch"):
        table.commit(_frame(spark, (1, "a", 1)), lambda before, batch: _frame(spark, *[(i, "a", 1) for i in range(50)]), T(1))
    with pytest.raises(FileNotFoundError):
        table.state()


def test_vacuum_keeps_what_is_needed_and_the_log_rewinds(spark, tmp_path):
    table, rng = _table(spark, tmp_path), random.Random(7)
    states = []
    for version in range(1, 8):
        made = {rng.randrange(60): (rng.choice("abc"), rng.random() < 0.3) for _ in range(25)}
        batch = spark.createDataFrame([(k, v, version, gone) for k, (v, gone) in made.items()], SCHEMA + ", gone boolean")
        table.commit(batch, replaced(["id"], "gone"), T(version))
        states.append(rows(table.state()))
    table.vacuum(keep=2)
    assert table.versions() == [6, 7] and [rows(table.state(v)) for v in (6, 7)] == states[5:]
    with pytest.raises(FileNotFoundError):
        table.state(5)
    needed = {(v, b) for m in map(table.manifest, (6, 7)) for b, v in enumerate(m.held) if v}
    left = {(int(n[8:]), int(b[7:])) for n in store.names(spark, f"{table.path}/state") for b in store.names(spark, f"{table.path}/state/{n}") if b.startswith("bucket=")}
    assert left == needed
    for version in range(1, 7):
        feed = table.changes(version + 1)
        assert rows(cdc.rewound(table.state(), feed, ["id"])) == states[version - 1]
        # The net changes lead from the old rows to the new ones.
        net = cdc.net_changes(feed, ["id"])
        old = spark.createDataFrame(states[version - 1], SCHEMA)
        assert rows(cdc.apply_feed(old, net, ["id"])) == states[-1]
        assert same(net, cdc.snapshot_diff(old, table.state(), ["id"]))
    table.vacuum(keep=1, changes=2)
    assert rows(table.changes(6).groupBy("_commit_version").count().select("_commit_version")) == [(6,), (7,)]
    with pytest.raises(FileNotFoundError, match="versions 5"):
        table.changes(5)


def test_columns_may_be_added(spark, tmp_path):
    table = _table(spark, tmp_path, buckets=2)
    table.commit(_frame(spark, (1, "a", 1), (2, "a", 1)), upserted(["id"]), T(1))
    table.commit(_frame(spark, (2, "b", 2)).withColumn("extra", F.lit(5)), upserted(["id"]), T(2))
    assert rows(table.state().select("id", "v", "extra")) == [(1, "a", None), (2, "b", 5)]
    assert rows(table.changes(2).select("_change_type", "id", "extra")) == [("update_postimage", 2, 5), ("update_preimage", 2, None)]
    table.commit(_frame(spark, (3, "c", 3)), upserted(["id"]), T(3))
    assert rows(table.state().select("id", "extra")) == [(1, None), (2, 5), (3, None)]


def test_merge_as_a_step(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "m"), ["id"], 4)
    start = spark.createDataFrame([(i, "a", "new") for i in range(10)], "id int, v string, status string")
    table.commit(start, upserted(["id"]), T(1))
    changes = spark.createDataFrame(
        [(1, "x", "up", "U", 1), (2, None, None, "D", 1), (20, "n", "new", "I", 1), (21, "n", "new", "U", 1)],
        "id int, v string, status string, operation string, seq int",
    )
    table.commit(changes, lambda before, batch: cdc.merge(before, batch, ["id"], ["v", "status"], T(2), sequence="seq"), T(2))
    assert rows(table.changes(2).select("_change_type", "id", "v")) == [
        ("delete", 2, "a"), ("insert", 20, "n"), ("update_postimage", 1, "x"), ("update_preimage", 1, "a"),
    ]
    assert table.state().count() == 10


def test_tombstones_are_deletes_in_the_log(spark, tmp_path):
    batch = lambda *made: spark.createDataFrame(list(made), "id int, seq int, op string")
    place = str(tmp_path / "s")
    incremental.apply_batch(batch((1, 1, "I"), (2, 1, "I")), 0, place, ["id"], "seq", "op = 'D'", 4)
    table = incremental.apply_batch(batch((1, 5, "D"), (3, 5, "D")), 1, place, ["id"], "seq", "op = 'D'", 4)
    assert rows(table.changes(2).select("_change_type", "id")) == [("delete", 1)]
    table = incremental.apply_batch(batch((1, 3, "U"), (3, 9, "I")), 2, place, ["id"], "seq", "op = 'D'", 4)
    assert rows(table.changes(3).select("_change_type", "id")) == [("insert", 3)]
    assert len(table.versions()) == 2


def test_another_shape_is_refused(spark, tmp_path):
    _table(spark, tmp_path)
    with pytest.raises(ValueError, match="8 buckets"):
        _table(spark, tmp_path, buckets=4)
    with pytest.raises(FileExistsError):
        store.write_text(spark, str(tmp_path / "t" / "table.json"), "{}")
