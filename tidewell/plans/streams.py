"""Event-stream operators: as batch aggregates, and as real streams over the event file."""

from __future__ import annotations

import datetime
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewell import catalog, sources
from tidewell.plans import sql
from tidewell.plans.registry import Registry
from tidewell.session import scratch_dir
from tidewell.streaming import events as ev
from tidewell.streaming import batches, incremental, sinks

R = Registry()


def _clean(spark, folder):
    return ev.clean_events(catalog.events(spark, folder))


def _stream(spark, folder):
    return ev.clean_events(catalog.event_stream(spark, folder))


def _ran(spark, stream, name):
    """Run a stream over everything that is there into Parquet and read the result."""
    out = scratch_dir(spark, name)
    sinks.write_parquet(stream, out, scratch_dir(spark, f"{name}-checkpoint"), trigger=sinks.ONCE).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@R.add(sql.query("happened", f"""SELECT event_id, event_type, {sql.dbl('amount')} AS amount, ts AS event_timestamp
    FROM happened"""))
def cleaned_events(spark, folder):
    return _clean(spark, folder).select("event_id", "event_type", "amount", "event_timestamp")


_SLIDING = f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, COUNT(event_id) AS event_count,
        {sql.total('amount')} AS t, {sql.big('SUM(quantity)')} AS total_quantity, COUNT(amount) AS n
    FROM (SELECT *, UNNEST(range(0, 5)) AS back FROM happened),
         LATERAL (SELECT date_trunc('minute', ts) - back * INTERVAL 1 MINUTE AS window_start)
    GROUP BY ALL"""
_SLIDING_SQL = f"""SELECT window_start, window_end, event_type, event_count, {sql.dbl('t')} AS total_amount, total_quantity,
    {sql.mean_money('t', 'n')} AS avg_amount FROM s"""
_TUMBLING = f"""SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
        product_id, COUNT(*) AS events, {sql.dbl(sql.total('amount'))} AS revenue, {sql.big('SUM(quantity)')} AS units_sold
    FROM happened GROUP BY ALL"""
_PURCHASES = f"""SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
        {sql.dbl(sql.total('amount'))} AS revenue, COUNT(event_id) AS transactions,
        {sql.mean_money(sql.total('amount'), 'COUNT(amount)')} AS avg_transaction
    FROM happened WHERE event_type = 'purchase' GROUP BY ALL"""


def _closed(seen: str, minutes: int) -> str:
    """Windows that end at or before the watermark: what append mode has emitted."""
    return f"WHERE window_end <= (SELECT date_trunc('millisecond', MAX(ts)) FROM {seen}) - INTERVAL {minutes} MINUTE"


@R.add(sql.query("happened", _SLIDING_SQL, s=_SLIDING))
def sliding_windows(spark, folder):
    return ev.sliding_agg(_clean(spark, folder))


@R.add(sql.query("happened", _TUMBLING))
def tumbling_windows(spark, folder):
    return ev.tumbling_agg(_clean(spark, folder))


@R.add(sql.query("happened", _PURCHASES))
def purchase_minutes(spark, folder):
    return ev.purchase_revenue(_clean(spark, folder))


@R.add(sql.query("happened", f"{_SLIDING_SQL} {_closed('happened', 10)}", s=_SLIDING))
def sliding_stream(spark, folder):
    return _ran(spark, ev.sliding_agg(_stream(spark, folder)), "sliding")


@R.add(sql.query("happened", f"SELECT * FROM t {_closed('happened', 5)}", t=_TUMBLING))
def tumbling_stream(spark, folder):
    return _ran(spark, ev.tumbling_agg(_stream(spark, folder)), "tumbling")


@R.add(sql.query("happened", f"""SELECT * FROM p {_closed("(SELECT ts FROM happened WHERE event_type = 'purchase')", 2)}""",
    p=_PURCHASES))
def purchase_stream(spark, folder):
    return _ran(spark, ev.purchase_revenue(_stream(spark, folder)), "purchases")


@R.add(sql.query("happened", f"SELECT event_id, event_type, {sql.dbl('amount')} AS amount FROM happened"))
def deduplicated_stream(spark, folder):
    """Every event is sent twice; one copy of each arrives."""
    once = _stream(spark, folder)
    twice = once.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return _ran(spark, ev.dedup(twice).select("event_id", "event_type", "amount"), "dedup")


@R.add(sql.query("sent", f"""SELECT event_id AS kafka_key, event_id, event_type, user_id, product_id,
    {sql.dbl('amount')} AS amount, quantity FROM sent"""))
def kafka_records(spark, folder):
    """Events encoded as Kafka records and decoded again."""
    events = catalog.events(spark, folder)
    records = ev.encode_kafka(events, "event_id").withColumn("timestamp", F.current_timestamp())
    decoded = ev.decode_kafka(records.withColumn("value", F.col("value").cast("binary")))
    return decoded.select("kafka_key", "event_id", "event_type", "user_id", "product_id", "amount", "quantity")


@R.add(sql.query("moves", f"""SELECT user_id, {sql.dbl('balance')} AS balance, status, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, event_id DESC) AS place FROM moves)
    WHERE place = 1 AND operation <> 'DELETE'"""))
def incremental_state(spark, folder):
    """User state kept by an incremental run over the event file, twice: the second finds nothing new."""
    state, checkpoint = scratch_dir(spark, "state"), scratch_dir(spark, "state-checkpoint")
    for _ in range(2):
        incremental.run_incremental(
            spark, f"{folder}/events.parque[t]", state, checkpoint,
            schema=catalog.table(spark, folder, "events").schema, keys=["user_id"], sequence="updated_at",
            is_delete="operation = 'DELETE'", transform=catalog.as_changes, buckets=8,
        )
    return incremental.current_state(spark, state).select("user_id", "balance", "status", "updated_at")


# --- deliveries -------------------------------------------------------------------------------

# Events that come with the first delivery; all others come with the second.
_EARLY = "ts < TIMESTAMP '2024-01-20' AND event_type <> 'error'"


def _delivered(spark, folder, run, again=False):
    """Call ``run(stream, place)`` after each of two deliveries of the events; with ``again`` the second one has all of
    them once more."""
    place, raw = scratch_dir(spark, "deliveries"), catalog.table(spark, folder, "events")
    for early in (True, False):
        part = raw if again else raw.where(f"({_EARLY}) = {early}")
        part.write.mode("append").parquet(f"{place}/in")
        stream = spark.readStream.schema(catalog.SCHEMAS["events"]).parquet(f"{place}/in")
        run(catalog.as_events(stream), place)
    return place


_LATE = f"""event_type = 'error' AND ts < (SELECT MAX(ts) FROM happened WHERE {_EARLY}) - INTERVAL 10 MINUTE"""


def _split_late(spark, folder):
    delay = datetime.timedelta(minutes=10)

    def run(stream, place):
        batches.split_late(ev.clean_events(stream), f"{place}/out", f"{place}/late", f"{place}/checkpoint", delay)

    return _delivered(spark, folder, run)


@R.add(sql.query("happened", f"""SELECT event_id, event_type, {sql.dbl('amount')} AS amount, ts AS event_timestamp FROM happened
    WHERE {_LATE}"""))
def late_events(spark, folder):
    """Events of the second delivery that lie behind the first one's watermark, in a table of their own."""
    late = batches.written(spark, f"{_split_late(spark, folder)}/late")
    return late.select("event_id", "event_type", "amount", "event_timestamp")


@R.add(sql.query("happened", f"""SELECT event_id, event_type, {sql.dbl('amount')} AS amount, ts AS event_timestamp FROM happened
    WHERE NOT ({_LATE})"""))
def timely_events(spark, folder):
    timely = batches.written(spark, f"{_split_late(spark, folder)}/out")
    return timely.select("event_id", "event_type", "amount", "event_timestamp")


@R.add(sql.query("happened", f"SELECT event_id, event_type, {sql.dbl('amount')} AS amount FROM happened"))
def first_copies(spark, folder):
    """Every event is delivered again, weeks behind any watermark; the first copy of each arrives."""

    def run(stream, place):
        batches.first_copies(ev.clean_events(stream), f"{place}/out", f"{place}/seen", f"{place}/checkpoint", ["event_id"], buckets=8)

    place = _delivered(spark, folder, run, again=True)
    return batches.written(spark, f"{place}/out").select("event_id", "event_type", "amount")


@R.add(sql.query("happened", _TUMBLING))
def updating_windows(spark, folder):
    """The latest figures of all windows, open ones too, from a stream in update mode that sees some windows twice."""
    kept = []

    def run(stream, place):
        windows = ev.tumbling_agg(ev.clean_events(stream), delay="60 days")
        kept[:] = [batches.keep_windows(windows, f"{place}/windows", f"{place}/checkpoint", ["window_start", "window_end", "product_id"], 8)]

    _delivered(spark, folder, run)
    return kept[0].state()


_RULES = {"priced": "amount > 50", "typed": "event_type IS NOT NULL", "small_quantity": "quantity < 50"}


def _checked(spark, folder):
    def run(stream, place):
        batches.checked(stream, f"{place}/out", f"{place}/history", f"{place}/checkpoint", _RULES, {"priced": "drop"})

    return _delivered(spark, folder, run)


@R.add(sql.query("sent", f"""SELECT event_id, event_type, quantity FROM sent WHERE amount > 50"""))
def stream_expectations(spark, folder):
    """Rows that a stream lets through: one rule drops, the others only count."""
    return batches.written(spark, f"{_checked(spark, folder)}/out").select("event_id", "event_type", "quantity")


_COUNTED = f"""SELECT CASE WHEN {_EARLY} THEN 0 ELSE 1 END AS batch, COUNT(*) AS total, COUNT(*) FILTER (amount > 50) AS priced,
    COUNT(event_type) AS typed, COUNT(*) FILTER (quantity < 50) AS small_quantity FROM sent GROUP BY 1"""


@R.add(sql.query("sent", " UNION ALL ".join(
    f"""SELECT batch, '{name}' AS expectation, '{'drop' if name == 'priced' else 'warn'}' AS action, {name} AS passed_records,
        total - {name} AS failed_records FROM counted""" for name in _RULES), counted=_COUNTED))
def rule_history(spark, folder):
    """How many rows met each rule, batch by batch, kept by the stream itself."""
    history = batches.rule_history(spark, f"{_checked(spark, folder)}/history")
    return history.select("batch", "expectation", "action", "passed_records", "failed_records")


@R.add(sql.query("sent", f"SELECT event_type, COUNT(*) AS events, TRUE AS stopped FROM sent WHERE {_EARLY} GROUP BY 1"))
def stopped_stream(spark, folder):
    """A rule that must not be broken stops the stream at the second delivery, before any row of it is written."""
    stopped = []

    def run(stream, place):
        try:
            rules = {"no_error": "event_type <> 'error'"}
            batches.checked(stream, f"{place}/out", f"{place}/history", f"{place}/checkpoint", rules, {"no_error": "fail"})
        except StreamingQueryException as error:
            stopped.append("no_error" in str(error))

    place = _delivered(spark, folder, run)
    through = batches.written(spark, f"{place}/out").groupBy("event_type").agg(F.count("*").alias("events"))
    return through.withColumn("stopped", F.lit(stopped == [True]))


# --- JSON -------------------------------------------------------------------------------------

_PRICE = "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)"


@R.add("""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
        CASE WHEN ts < TIMESTAMP '2024-01-15' OR event_type <> 'error' THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
        CASE WHEN ts < TIMESTAMP '2024-01-15' THEN NULL WHEN event_type = 'error'
            THEN '{"amount":"' || CAST(value AS DECIMAL(18,2)) || ' EUR","note":"n' || user_id || '"}'
            ELSE '{"note":"n' || user_id || '"}' END AS _rescued_data
    FROM events""")
def evolving_json_stream(spark, folder):
    """JSON files whose later ones have a new field and, in part, another type: what does not fit is kept."""
    place, raw = scratch_dir(spark, "evolving"), catalog.table(spark, folder, "events")
    early = F.col("ts") < F.lit(catalog.EVENTS_CUT)
    price = F.expr(_PRICE)
    number = F.when(~early & (F.col("event_type") == "error"), F.concat(F.lit('"'), price, F.lit(' EUR"'))).otherwise(price)
    note = F.when(early, F.lit("")).otherwise(F.concat(F.lit(',"note":"n'), F.col("user_id"), F.lit('"')))
    line = F.concat(F.lit('{"event_id":"'), "event_id", F.lit('","event_type":"'), "event_type", F.lit('","amount":'), number, note, F.lit("}"))
    for part in (early, ~early):
        raw.where(part).select(line.alias("value")).write.mode("append").text(f"{place}/in")
        stream = ev.read_rescued_files(spark, f"{place}/in", f"{place}/schema")
        sinks.write_parquet(stream, f"{place}/out", f"{place}/checkpoint", trigger=sinks.ONCE).awaitTermination()
    return spark.read.parquet(f"{place}/out").select("event_id", "event_type", "amount", "_rescued_data")


@R.add("SELECT event_type, COUNT(*) AS events, CAST(SUM(user_id) AS BIGINT) AS users FROM events GROUP BY 1")
def json_file_stream(spark, folder):
    """JSON-lines files as they arrive."""
    place, raw = scratch_dir(spark, "json-stream"), catalog.table(spark, folder, "events")
    raw.select(F.col("event_id").cast("string"), "event_type", F.col("user_id").cast("string")).write.json(f"{place}/in")
    stream = ev.read_json_stream(spark, f"{place}/in", files_per_trigger=None)
    found = _ran(spark, stream, "json-events").groupBy("event_type")
    return found.agg(F.count("*").alias("events"), F.sum(F.col("user_id").cast("long")).alias("users"))


@R.add("SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, length(text) AS characters FROM conversations")
def json_documents(spark, folder):
    """Files that each hold one JSON document over many lines: an array of turns."""
    place, talk = scratch_dir(spark, "json-documents"), catalog.table(spark, folder, "conversations")
    # A document takes the turns of about a hundred conversations.
    turns = talk.groupBy(F.expr("conv_id DIV 100").alias("part")).agg(F.collect_list(F.struct("conv_id", "turn", "role", "text")).alias("turns"))
    pretty = F.to_json("turns", {"pretty": "true"})
    turns.select("part", pretty.alias("value")).write.partitionBy("part").text(place)
    read = sources.read_json(spark, place, "conv_id long, turn long, role string, text string", multi_line=True)
    return read.select("conv_id", "turn", "role", F.length("text").cast("long").alias("characters"))


# --- sinks for looking ------------------------------------------------------------------------


@R.add(sql.query("happened", f"SELECT event_type, COUNT(*) AS events, {sql.dbl(sql.total('amount'))} AS amount FROM happened GROUP BY 1"))
def debug_counts(spark, folder):
    """Counts in complete mode in a table in memory."""
    counts = _stream(spark, folder).groupBy("event_type").agg(F.count("*").alias("events"), F.sum("amount").alias("amount"))
    name = f"debug_{uuid.uuid4().hex}"
    sinks.write_debug(counts, "complete", "memory", name, sinks.ONCE).awaitTermination()
    return spark.table(name)


@R.add("SELECT COUNT(*) AS input_rows FROM events")
def stream_progress(spark, folder):
    """Rows that the micro-batches of a stream report to have read."""
    stream, out = catalog.event_stream(spark, folder), scratch_dir(spark, "progress")
    query = sinks.write_parquet(stream, out, f"{out}-checkpoint", trigger=sinks.ONCE)
    query.awaitTermination()
    return sinks.progress_frame(spark, query).agg(F.sum("input_rows").alias("input_rows"))
