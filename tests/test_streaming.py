from __future__ import annotations

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell import catalog
from tidewell.streaming import events as ev
from tidewell.streaming import incremental, sinks

ALL_AT_ONCE = {"availableNow": True}


def _event(i, minute, kind="purchase", amount=10.0, product="p1", quantity=1):
    stamp = f"2024-01-01 {10 + minute // 60:02d}:{minute % 60:02d}:30"
    return {
        "event_id": f"e{i}", "event_type": kind, "user_id": "u1", "product_id": product, "amount": amount,
        "quantity": quantity, "timestamp": stamp, "metadata": None,
    }


def _write(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, events)))


@pytest.fixture
def places(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")


def test_cleaning_drops_bad_events(spark, places):
    source, _, _ = places
    _write(source, "a.json", [_event(1, 0), _event(2, 1, kind=None), _event(3, 2, amount=0.0), _event(4, 3, amount=None)])
    cleaned = ev.clean_events(spark.read.schema(ev.EVENT_SCHEMA).json(str(source)))
    assert [r.event_id for r in cleaned.collect()] == ["e1"]
    assert dict(cleaned.dtypes)["event_timestamp"] == "timestamp"


def test_stream_equals_batch_for_closed_windows(spark, places):
    source, out, checkpoint = places
    made = [_event(i, i % 40, kind=["purchase", "view"][i % 2], amount=1.0 + i) for i in range(80)]
    _write(source, "a.json", made)
    _write(source, "z.json", [_event(999, 500)])
    sinks.run_windows(spark, str(source), out, checkpoint).awaitTermination()
    batch = ev.sliding_agg(ev.clean_events(spark.read.schema(ev.EVENT_SCHEMA).json(str(source))))
    closed = batch.where("window_end < timestamp'2024-01-01 17:00:00'")
    assert same(spark.read.parquet(out), closed)


def test_restart_repeats_nothing(spark, places):
    source, out, checkpoint = places
    _write(source, "a.json", [_event(i, i) for i in range(5)])
    _write(source, "b.json", [_event(10, 100)])
    sinks.run_purchase_revenue(spark, str(source), out, checkpoint).awaitTermination()
    first = rows(spark.read.parquet(out))
    sinks.run_purchase_revenue(spark, str(source), out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out)) == first
    assert len(first) == 5
    _write(source, "c.json", [_event(11, 200)])
    sinks.run_purchase_revenue(spark, str(source), out, checkpoint).awaitTermination()
    assert len(rows(spark.read.parquet(out))) == 6


def test_late_file_is_dropped(spark, places):
    source, out, checkpoint = places
    _write(source, "a.json", [_event(1, 0), _event(2, 120)])
    sinks.run_windows(spark, str(source), out, checkpoint).awaitTermination()
    _write(source, "b.json", [_event(3, 0, amount=1000.0), _event(4, 240)])
    sinks.run_windows(spark, str(source), out, checkpoint).awaitTermination()
    found = spark.read.parquet(out).where("window_start < timestamp'2024-01-01 10:30:00'")
    assert found.agg(F.max("total_amount"), F.max("event_count")).first() == (10, 1)


@pytest.mark.parametrize("salts", [0, 3])
def test_duplicate_ids_arrive_once(spark, places, salts):
    source, out, checkpoint = places
    _write(source, "a.json", [_event(1, 0), _event(1, 0), _event(2, 1)])
    _write(source, "b.json", [_event(1, 0), _event(3, 2)])
    stream = ev.dedup(ev.clean_events(ev.read_json_stream(spark, str(source))), salts=salts).select("event_id")
    sinks.write_parquet(stream, out, checkpoint, trigger=ALL_AT_ONCE).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("e1",), ("e2",), ("e3",)]


def test_output_modes_and_progress(spark, places):
    source, _, _ = places
    _write(source, "a.json", [_event(1, 0), _event(2, 1)])
    stream = ev.clean_events(ev.read_json_stream(spark, str(source)))
    query = sinks.write_debug(ev.tumbling_agg(stream), "complete", "memory", "tumbled", ALL_AT_ONCE)
    query.awaitTermination()
    assert spark.table("tumbled").count() == 2
    report = sinks.progress_frame(spark, query)
    assert report.agg(F.sum("input_rows")).first()[0] == 2
    update = sinks.write_debug(ev.tumbling_agg(stream), "update", "memory", "updated", ALL_AT_ONCE)
    update.awaitTermination()
    assert spark.table("updated").count() == 2


def test_new_files_bring_new_columns(spark, places, tmp_path):
    source, out, checkpoint = places
    _write(source, "a.json", [{"product_id": "p1", "price": 2.5}])
    schema_path = str(tmp_path / "schema")
    stream = ev.read_new_files(spark, str(source), schema_path)
    sinks.write_parquet(stream, out, checkpoint, trigger=ALL_AT_ONCE).awaitTermination()
    _write(source, "b.json", [{"product_id": "p2", "price": 3.5, "extra": "x"}])
    again = ev.read_new_files(spark, str(source), schema_path)
    assert again.columns == ["price", "product_id", "extra"]
    sinks.write_parquet(again, out, checkpoint, trigger=ALL_AT_ONCE).awaitTermination()
    found = spark.read.option("mergeSchema", True).parquet(out).select("product_id", "price", "extra")
    assert rows(found) == [("p1", 2.5, None), ("p2", 3.5, "x")]
    assert ev.read_new_files(spark, str(source), schema_path).columns == again.columns


def test_event_stream_reads_files_and_folders(spark, data, tmp_path):
    events = catalog.table(spark, data, "events")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    counts = []
    for folder in (data, str(tmp_path)):
        out = tempfile.mkdtemp(dir=tmp_path)
        stream = catalog.event_stream(spark, folder)
        sinks.write_parquet(stream, f"{out}/rows", f"{out}/checkpoint", trigger=ALL_AT_ONCE).awaitTermination()
        counts.append(spark.read.parquet(f"{out}/rows").count())
    assert counts == [events.count()] * 2


def test_state_refuses_another_number_of_buckets(spark, tmp_path):
    batch = spark.createDataFrame([(1, 1, "a", "U")], SCHEMA)
    incremental.apply_batch(batch, 0, str(tmp_path / "s"), ["id"], "seq", buckets=4)
    with pytest.raises(ValueError, match="4 buckets"):
        incremental.apply_batch(batch, 1, str(tmp_path / "s"), ["id"], "seq", buckets=8)


def test_kafka_round_trip(spark):
    made = spark.createDataFrame([tuple(_event(1, 0).values())], ev.EVENT_SCHEMA)
    records = ev.encode_kafka(made, "event_id").withColumn("timestamp", F.current_timestamp())
    decoded = ev.decode_kafka(records)
    assert decoded.columns == [*made.columns, "kafka_key", "kafka_timestamp"]
    assert same(decoded.select(*made.columns), made) and decoded.first().kafka_key == "e1"


SCHEMA = "id int, seq int, v string, op string"


def _run(spark, source, out, checkpoint, **options):
    incremental.run_incremental(
        spark, str(source), out, checkpoint, SCHEMA, ["id"], "seq", is_delete="op = 'D'", buckets=4,
        source_format="json", **options,
    )
    return rows(incremental.current_state(spark, out).select("id", "v"))


def _changes(*made):
    return [dict(zip(("id", "seq", "v", "op"), m)) for m in made]


def test_incremental_state(spark, places):
    source, out, checkpoint = places
    _write(source, "a.json", _changes((1, 1, "a", "I"), (2, 1, "b", "I"), (2, 3, None, "D"), (3, 5, "c", "I")))
    assert _run(spark, source, out, checkpoint) == [(1, "a"), (3, "c")]
    # A late older event does not undo a newer one, nor revive a deleted key.
    _write(source, "b.json", _changes((2, 2, "late", "U"), (3, 4, "late", "U"), (4, 1, "d", "I")))
    assert _run(spark, source, out, checkpoint) == [(1, "a"), (3, "c"), (4, "d")]
    assert _run(spark, source, out, checkpoint) == [(1, "a"), (3, "c"), (4, "d")]
    _write(source, "c.json", _changes((2, 9, "back", "I"), (1, 9, None, "D")))
    assert _run(spark, source, out, checkpoint) == [(2, "back"), (3, "c"), (4, "d")]


def test_repeated_batch_changes_nothing(spark, places):
    _, out, _ = places
    first = spark.createDataFrame([(1, 1, "a", "I"), (2, 1, "b", "I")], SCHEMA)
    second = spark.createDataFrame([(1, 2, "x", "U"), (2, 2, None, "D")], SCHEMA)
    incremental.apply_batch(first, 0, out, ["id"], "seq", "op = 'D'", 4)
    for _ in range(2):
        incremental.apply_batch(second, 1, out, ["id"], "seq", "op = 'D'", 4)
        assert rows(incremental.current_state(spark, out).select("id", "v")) == [(1, "x")]
    incremental.apply_batch(first.where("false"), 2, out, ["id"], "seq", "op = 'D'", 4)
    assert rows(incremental.current_state(spark, out).select("id", "v")) == [(1, "x")]


def test_incremental_transform_and_missing_state(spark, places):
    source, out, checkpoint = places
    with pytest.raises(FileNotFoundError):
        incremental.current_state(spark, out)
    _write(source, "a.json", _changes((1, 1, "a", "I")))
    found = _run(spark, source, out, checkpoint, transform=lambda df: df.withColumn("v", F.upper("v")))
    assert found == [(1, "A")]


def test_event_table_as_stream(spark, data, places):
    _, out, checkpoint = places
    stream = ev.clean_events(catalog.event_stream(spark, data)).select("event_id")
    sinks.write_parquet(stream, out, checkpoint, trigger=ALL_AT_ONCE).awaitTermination()
    assert same(spark.read.parquet(out), catalog.events(spark, data).select("event_id"))
