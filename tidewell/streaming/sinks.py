"""Stream writers and progress reports."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewell.streaming import events as ev

# One batch over everything that is there, then stop.
ONCE = {"availableNow": True}


def write_parquet(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Start a query into a Parquet folder; a restart with the same checkpoint repeats nothing."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path)


def write_debug(
    df: DataFrame, mode: str = "complete", sink: str = "console", name: str | None = None, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Console (or in-memory table ``name``) output, for looking at small streams only."""
    writer = df.writeStream.format(sink).outputMode(mode)
    if sink == "console":
        writer = writer.option("truncate", False)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def write_kafka(df: DataFrame, servers: str, topic: str, key_column: str, checkpoint: str) -> StreamingQuery:
    """Rows as JSON into a Kafka topic; needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return ev.encode_kafka(df, key_column).writeStream.format("kafka").options(**options).start()


def run_windows(
    spark: SparkSession, source: str, out: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Read JSON events, clean, aggregate in sliding windows, append closed windows to Parquet."""
    stream = ev.clean_events(ev.read_json_stream(spark, source))
    return write_parquet(ev.sliding_agg(stream), out, checkpoint, trigger=trigger or ONCE)


def run_purchase_revenue(
    spark: SparkSession, source: str, out: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Revenue per minute of purchase events, appended to Parquet."""
    stream = ev.clean_events(ev.read_json_stream(spark, source))
    return write_parquet(ev.purchase_revenue(stream), out, checkpoint, trigger=trigger or ONCE)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent micro-batches of a query; Spark keeps the last 100."""
    rows = [
        (
            p["name"],
            p["batchId"],
            p["timestamp"],
            p["numInputRows"],
            p["durationMs"].get("triggerExecution", 0),
            (p.get("eventTime") or {}).get("watermark"),
        )
        for p in query.recentProgress
    ]
    schema = "name string, batch_id long, started string, input_rows long, duration_ms long, watermark string"
    return spark.createDataFrame(rows, schema)
