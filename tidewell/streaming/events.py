"""Event streams: reading, cleaning, windowed aggregates.

The transformations are the same functions for streaming and for batch frames; a watermark has no
effect on a batch frame.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from tidewell.functions.numbers import MONEY, mean_money, money
from tidewell.sources.files import parse_json

EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("event_type", StringType()),
        StructField("user_id", StringType()),
        StructField("product_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("quantity", IntegerType()),
        StructField("timestamp", StringType()),
        StructField("metadata", StringType()),
    ]
)

# --- sources ----------------------------------------------------------------------------------


def read_json_stream(
    spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA, files_per_trigger: int | None = 1
) -> DataFrame:
    """JSON-lines files as they arrive, ``files_per_trigger`` per micro-batch (None: all at once)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def decode_kafka(records: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Columns of the JSON value, plus ``kafka_key`` and ``kafka_timestamp``."""
    return records.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
    ).select("data.*", "kafka_key", "kafka_timestamp")


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str, schema: StructType = EVENT_SCHEMA, starting: str = "latest"
) -> DataFrame:
    """Decoded Kafka records; needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    return decode_kafka(spark.readStream.format("kafka").options(**options).load(), schema)


def _merged(known: StructType, seen: StructType) -> StructType:
    """The known fields as they are, and the new ones behind them."""
    names = {f.name.lower() for f in known.fields}
    return StructType([*known.fields, *[f for f in seen.fields if f.name.lower() not in names]])


def remembered_schema(spark: SparkSession, path: str, schema_path: str) -> StructType:
    """The schema stored under ``schema_path``, widened by the columns that the files have got since.

    Known columns keep their types; a widened schema is stored as a further version, and the one with most columns is
    the latest. A running stream keeps its schema: new columns are read from its next start on.
    """
    known = StructType([])
    try:
        stored = spark.read.option("wholetext", True).text(schema_path).collect()
        known = max((StructType.fromJson(json.loads(r[0])) for r in stored), key=lambda s: len(s.fields), default=known)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    schema = _merged(known, spark.read.json(path).schema)
    if len(schema.fields) > len(known.fields):
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("append").text(schema_path)
    return schema


def read_new_files(spark: SparkSession, path: str, schema_path: str, **options: str) -> DataFrame:
    """New JSON files of a folder, with an inferred schema that is remembered and widened across restarts."""
    return spark.readStream.schema(remembered_schema(spark, path, schema_path)).options(**options).json(path)


def read_rescued_files(spark: SparkSession, path: str, schema_path: str, **options: str) -> DataFrame:
    """As :func:`read_new_files`, but a field whose type has changed, or that the remembered schema does not have, is kept
    in ``_rescued_data`` instead of becoming NULL or being left out. The schema is remembered from the first files on and
    does not widen by itself: :func:`remembered_schema` widens it."""
    try:
        stored = spark.read.option("wholetext", True).text(schema_path).collect()
        schema = max((StructType.fromJson(json.loads(r[0])) for r in stored), key=lambda s: len(s.fields))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = remembered_schema(spark, path, schema_path)
    lines = spark.readStream.options(**options).text(path)
    return parse_json(lines, schema)


# --- transformations --------------------------------------------------------------------------


def clean_events(events: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Typed event time and processing time; rows without type or with amount <= 0 are removed."""
    textual = dict(events.dtypes)[time_column] == "string"
    moment = F.try_to_timestamp(time_column) if textual else F.col(time_column).cast("timestamp")
    return events.where(F.col("event_type").isNotNull() & (F.col("amount") > 0)).withColumns(
        {
            "amount": money(F.col("amount")),
            "event_timestamp": moment,
            "processing_time": F.current_timestamp(),
        }
    )


def dedup(events: DataFrame, key: str = "event_id", delay: str = "10 minutes", salts: int = 0) -> DataFrame:
    """First copy of every event id; state older than the watermark is dropped.

    All copies of an id meet in one task. If copies of one id can make up a large share of a
    batch, ``salts`` adds a first round that keeps at most ``salts`` copies per id, at the price of
    a second state.
    """
    timed = events.withWatermark("event_timestamp", delay)
    if salts:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        timed = timed.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark([key])


def _bounds(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others)


def sliding_agg(
    events: DataFrame, size: str = "5 minutes", slide: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Overlapping windows per event type: events, amount, average, quantity."""
    grouped = (
        events.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", size, slide), "event_type")
        .agg(
            F.count("event_id").alias("event_count"),
            F.sum("amount").cast(MONEY).alias("total_amount"),
            F.sum("quantity").alias("total_quantity"),
            mean_money(F.sum("amount"), F.count("amount")).alias("avg_amount"),
        )
    )
    return _bounds(grouped)


def tumbling_agg(events: DataFrame, size: str = "1 minute", delay: str = "5 minutes") -> DataFrame:
    """Adjacent windows per product: events, revenue, units."""
    grouped = (
        events.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", size), "product_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("amount").cast(MONEY).alias("revenue"),
            F.sum("quantity").alias("units_sold"),
        )
    )
    return _bounds(grouped)


def purchase_revenue(events: DataFrame, size: str = "1 minute", delay: str = "2 minutes") -> DataFrame:
    """Purchases per minute: revenue, transactions, average."""
    grouped = (
        events.where(F.col("event_type") == "purchase")
        .withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", size))
        .agg(
            F.sum("amount").cast(MONEY).alias("revenue"),
            F.count("event_id").alias("transactions"),
            mean_money(F.sum("amount"), F.count("amount")).alias("avg_transaction"),
        )
    )
    return _bounds(grouped)


def encode_kafka(df: DataFrame, key_column: str) -> DataFrame:
    """``key`` and ``value`` (the row as JSON) for a Kafka sink."""
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(F.col(key_column).cast("string").alias("key"), row.alias("value"))
