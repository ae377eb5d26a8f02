from __future__ import annotations

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell import sources
from tidewell.streaming import batches
from tidewell.streaming import events as ev

SCHEMA = "id string, v int, event_timestamp timestamp"
T = lambda minute: datetime.datetime(2024, 1, 1, 10) + datetime.timedelta(minutes=minute)
TEN = datetime.timedelta(minutes=10)


@pytest.fixture
def feed(spark, tmp_path):
    """Deliver rows and run an operator on the stream of them."""

    def deliver(run, *made, schema=SCHEMA):
        spark.createDataFrame(list(made), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return run(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path))

    return deliver


def _read(spark, path, *columns):
    return rows(batches.written(spark, path).select(*columns))


def test_late_rows_get_a_table(spark, tmp_path, feed):
    run = lambda stream, p: batches.split_late(stream, f"{p}/out", f"{p}/late", f"{p}/c", TEN)
    feed(run, ("a", 1, T(0)), ("b", 1, T(60)), ("n", 1, None))
    feed(run, ("c", 1, T(51)), ("d", 1, T(49)), ("e", 1, T(5)))
    # A batch without anything new on time leaves the watermark where it was.
    feed(run, ("f", 1, T(20)))
    feed(run, ("g", 1, T(50)))
    assert _read(spark, f"{tmp_path}/out", "id") == [("a",), ("b",), ("c",), ("g",)]
    assert _read(spark, f"{tmp_path}/late", "id", "batch") == [("d", 1), ("e", 1), ("f", 2), ("n", 0)]
    assert batches.watermark(spark, f"{tmp_path}/late_watermarks", 0) is None


def test_first_copies_outlive_any_watermark(spark, tmp_path, feed):
    run = lambda stream, p: batches.first_copies(stream, f"{p}/out", f"{p}/seen", f"{p}/c", ["id"], buckets=4)
    feed(run, ("a", 1, T(5)), ("a", 2, T(0)), ("b", 1, T(0)), (None, 1, T(0)))
    feed(run, ("a", 3, T(90_000)), ("c", 1, T(90_000)), ("c", 1, T(90_000)))
    feed(run, ("c", 9, T(1)), ("b", 9, T(1)))
    assert _read(spark, f"{tmp_path}/out", "id", "v") == [("a", 2), ("b", 1), ("c", 1), (None, 1)]


def test_first_copies_may_be_forgotten(spark, tmp_path, feed):
    run = lambda stream, p: batches.first_copies(stream, f"{p}/out", f"{p}/seen", f"{p}/c", ["id"], keep=TEN, buckets=1)
    feed(run, ("a", 1, T(0)), ("b", 1, T(0)))
    feed(run, ("a", 2, T(5)), ("c", 1, T(30)))
    feed(run, ("a", 3, T(31)), ("c", 2, T(31)))
    assert _read(spark, f"{tmp_path}/out", "id", "v") == [("a", 1), ("a", 3), ("b", 1), ("c", 1)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, feed, monkeypatch):
    """The batch is written and committed, and the stream dies before Spark's own checkpoint knows."""
    table = batches.VersionedTable
    run = lambda stream, p: batches.first_copies(stream, f"{p}/out", f"{p}/seen", f"{p}/c", ["id"], buckets=2)
    vacuum = table.vacuum
    for broken in ("commit", "vacuum"):
        with monkeypatch.context() as patched:
            patched.setattr(table, broken, lambda *a, **k: 1 / 0)
            with pytest.raises(StreamingQueryException):
                feed(run, (broken, 1, T(0)), ("x", 1, T(0)))
    assert table.vacuum is vacuum
    feed(run, ("x", 2, T(1)))
    assert sorted(set(_read(spark, f"{tmp_path}/out", "id"))) == _read(spark, f"{tmp_path}/out", "id") == [("commit",), ("vacuum",), ("x",)]


def test_open_windows_are_replaced(spark, tmp_path, feed):
    def run(stream, p):
        windows = stream.withWatermark("event_timestamp", "1 day").groupBy(F.window("event_timestamp", "10 minutes"), "id").agg(F.sum("v").alias("v"))
        return batches.keep_windows(ev._bounds(windows), f"{p}/w", f"{p}/c", ["window_start", "window_end", "id"], 4)

    feed(run, ("a", 1, T(1)), ("a", 2, T(2)), ("b", 5, T(11)))
    kept = feed(run, ("a", 10, T(3)), ("a", 7, T(12)))
    assert rows(kept.state().select("id", "v")) == [("a", 13), ("a", 7), ("b", 5)]
    assert rows(kept.changes(2).select("_change_type", "id", "v")) == [("insert", "a", 7), ("update_postimage", "a", 13), ("update_preimage", "a", 3)]


def test_expectations_in_a_stream(spark, tmp_path, feed):
    rules = {"positive": "v > 0", "named": "id IS NOT NULL", "bounded": "v IS NULL OR v < 100"}
    actions = {"positive": "drop", "bounded": "fail"}
    run = lambda stream, p: batches.checked(stream, f"{p}/out", f"{p}/history", f"{p}/c", rules, actions)
    assert batches.rule_history(spark, f"{tmp_path}/history").isEmpty()
    feed(run, ("a", 1, T(0)), ("b", -1, T(0)), (None, 2, T(0)), ("c", None, T(0)))
    with pytest.raises(StreamingQueryException, match="bounded: 1 rows"):
        feed(run, ("d", 5, T(0)), ("e", 500, T(0)))
    assert _read(spark, f"{tmp_path}/out", "id") == [("a",), (None,)]
    history = batches.rule_history(spark, f"{tmp_path}/history")
    assert rows(history.select("batch", "expectation", "action", "passed_records", "failed_records")) == [
        (0, "bounded", "fail", 4, 0), (0, "named", "warn", 3, 1), (0, "positive", "drop", 2, 2),
    ]
    with pytest.raises(ValueError, match="unknown actions"):
        batches.checked(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), "", "", "", rules, {"named": "stop"})


def test_json_that_does_not_fit_is_kept(spark):
    lines = [
        '{"a": 1, "b": "x", "n": {"p": 1}}', '{"a": "text", "b": 5, "extra": [1, 2], "n": {"p": 2}}', '{"a": 1.5, "n": 7}', '{"a": null, "gone": null}',
        "{}", "not json", '{"a": 1', "[1, 2]", "5", "", None, '{"b": "line\\nbreak", "B": "case"}',
    ]
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    found = sources.parse_json(frame, "a int, b string, n struct<p:int>")
    assert found.columns == ["i", "a", "b", "n", "_rescued_data", "_corrupt_record"]
    got = {r.i: (r.a, r.b, r.n and r.n.p, r._rescued_data, r._corrupt_record) for r in found.collect()}
    assert got[0] == (1, "x", 1, None, None)
    assert got[1] == (None, "5", 2, '{"a":"text","extra":"[1,2]"}', None)
    assert got[2] == (None, None, None, '{"a":"1.5","n":"7"}', None)
    assert got[3] == got[4] == (None, None, None, None, None)
    assert [got[i][4] for i in (5, 6, 7, 8, 9)] == ["not json", '{"a": 1', "[1, 2]", "5", ""]
    assert got[10] == (None, None, None, None, None)
    assert got[11] == (None, "line\nbreak", None, '{"B":"case"}', None)


def test_rescued_files_keep_their_schema(spark, tmp_path):
    place, schema = tmp_path / "in", str(tmp_path / "schema")
    place.mkdir()
    seen = []
    for number, text in enumerate(['{"a": 1, "b": "x"}', '{"a": "y", "c": 2}']):
        (place / f"{number}.json").write_text(text + "\n")
        stream = ev.read_rescued_files(spark, str(place), schema)
        batches.each_batch(stream, lambda batch, _: seen.extend(tuple(r) for r in batch.collect()), str(tmp_path / "c"))
    assert seen == [(1, "x", None, None), (None, None, '{"a":"y","c":"2"}', None)]
    # The schema is widened on request, and then used.
    ev.remembered_schema(spark, str(place), schema)
    assert "c" in ev.read_rescued_files(spark, str(place), schema).columns


def test_stream_of_csv_files_keeps_corrupt_rows(spark, tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    (place / "a.csv").write_text("id,v\na,1\nb,x\n")
    seen = []
    stream = sources.stream_files(spark, str(place), "csv", "id string, v int")
    batches.each_batch(stream, lambda batch, _: seen.append(batch.select("id", "v", "_corrupt_record").collect()), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in seen[0]) == [("a", 1, None), ("b", None, "b,x")]
    assert same(sources.read_csv(spark, str(place), "id string, v int"), spark.createDataFrame(seen[0], "id string, v int, _corrupt_record string"))
