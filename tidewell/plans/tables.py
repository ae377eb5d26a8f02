"""Sources, sinks, layout, cleaning and joins."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import functions as F

from tidewell import catalog, sinks, sources
from tidewell.functions.numbers import MONEY, money
from tidewell.operators import clean, enrich, gold, quality, sketches, skew
from tidewell.plans import sql
from tidewell.plans.registry import Registry
from tidewell.session import scratch_dir
from tidewell.sinks import zones
from tidewell.sinks.layout import zvalue

R = Registry()


# --- sources ----------------------------------------------------------------------------------


@R.add(
    """SELECT l_returnflag, l_linestatus, COUNT(*) AS rows_read, COUNT(*) AS files_known, COUNT(*) AS marked
    FROM lineitem GROUP BY ALL"""
)
def bronze_parquet(spark, folder):
    raw = sources.read_parquet(spark, f"{folder}/lineitem.parquet")
    bronze = sources.with_constants(sources.with_audit(raw, "batch-1"), {"_is_fictional_data": True})
    return bronze.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("_source_file").endswith("lineitem.parquet")).alias("files_known"),
        F.count_if((F.col("_batch_id") == "batch-1") & F.col("_is_fictional_data")).alias("marked"),
    )


_ORDER_TEXT = f"""SELECT o_orderpriority, COUNT(*) AS orders_read,
    {sql.dbl(sql.total(f'CAST(o_totalprice AS {sql.MONEY})'))} AS total, MIN(CAST(o_orderdate AS DATE)) AS first_day,
    {{}} AS corrupt FROM orders GROUP BY 1"""


def _orders_as_text(spark, folder):
    return catalog.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast(MONEY).alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority",
    )


@R.add(_ORDER_TEXT.format("CAST(0 AS BIGINT)"))
def csv_fixed_schema(spark, folder):
    path = scratch_dir(spark, "orders-csv")
    rows = _orders_as_text(spark, folder)
    rows.write.option("header", True).csv(path)
    read = sources.read_csv(spark, path, rows.schema)
    return read.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders_read"), F.sum("o_totalprice").alias("total"), F.min("o_orderdate").alias("first_day"),
        F.count("_corrupt_record").alias("corrupt"),
    )


@R.add(_ORDER_TEXT.format("CAST(0 AS BIGINT)"))
def csv_inferred_schema(spark, folder):
    path = scratch_dir(spark, "orders-csv")
    _orders_as_text(spark, folder).write.option("header", True).csv(path)
    read = sources.read_csv(spark, path)
    return read.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders_read"), F.sum(money(F.col("o_totalprice"))).alias("total"),
        F.min("o_orderdate").alias("first_day"), F.lit(0).cast("bigint").alias("corrupt"),
    )


@R.add(sql.query("paid", f"""SELECT payment_method, status, COUNT(*) AS payments, {sql.dbl(sql.total('amount'))} AS total,
    CAST(0 AS BIGINT) AS corrupt FROM paid GROUP BY ALL"""))
def json_lines(spark, folder):
    path = scratch_dir(spark, "payments-json")
    rows = catalog.payments(spark, folder)
    rows.write.json(path)
    read = sources.read_json(spark, path, rows.schema)
    return read.groupBy("payment_method", "status").agg(
        F.count("*").alias("payments"), F.sum("amount").alias("total"), F.count("_corrupt_record").alias("corrupt")
    )


@R.add("""
    SELECT 'o_orderkey' AS "column", COUNT(*) AS row_count, COUNT(*) - COUNT(o_orderkey) AS null_count,
           CAST(MIN(o_orderkey) AS VARCHAR) AS min_value, CAST(MAX(o_orderkey) AS VARCHAR) AS max_value,
           COUNT(DISTINCT o_orderkey) AS distinct_count FROM orders
    UNION ALL SELECT 'o_custkey', COUNT(*), COUNT(*) - COUNT(o_custkey), CAST(MIN(o_custkey) AS VARCHAR),
           CAST(MAX(o_custkey) AS VARCHAR), COUNT(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', COUNT(*), COUNT(*) - COUNT(o_orderstatus), MIN(o_orderstatus),
           MAX(o_orderstatus), COUNT(DISTINCT o_orderstatus) FROM orders
    UNION ALL SELECT 'o_orderpriority', COUNT(*), COUNT(*) - COUNT(o_orderpriority), MIN(o_orderpriority),
           MAX(o_orderpriority), COUNT(DISTINCT o_orderpriority) FROM orders""")
def profile_orders(spark, folder):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return quality.profile(catalog.table(spark, folder, "orders"), columns, exact=True)


_STATS = """SELECT '{0}' AS "column", COUNT({0}) AS count, ROUND(AVG({0}), 4) AS mean, ROUND(STDDEV_SAMP({0}), 4) AS stddev,
    MIN({0})::DOUBLE AS min, MAX({0})::DOUBLE AS max FROM lineitem"""


@R.add(" UNION ALL ".join(_STATS.format(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def describe_lines(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stats = quality.describe(catalog.table(spark, folder, "lineitem"), columns)
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


# --- sinks and layout -------------------------------------------------------------------------


@R.add("""SELECT CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
    COUNT(*) AS orders_read FROM orders GROUP BY 1""")
def append_new_column(spark, folder):
    """Two appends, the second with one more column, read back with merged schemas."""
    path = scratch_dir(spark, "appended")
    orders = catalog.table(spark, folder, "orders")
    early = F.col("o_orderdate") < F.lit(datetime.datetime(1998, 1, 1))
    sinks.append(orders.where(early).select("o_orderkey"), path)
    sinks.append(orders.where(~early).select("o_orderkey", "o_orderpriority"), path)
    merged = sources.read_parquet(spark, path, merge_schema=True)
    return merged.groupBy("o_orderpriority").agg(F.count("*").alias("orders_read"))


@R.add(f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS rows_kept,
    {sql.dbl(f"CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_extendedprice AS {sql.MONEY}) END) AS {sql.MONEY})")}
        AS total FROM lineitem GROUP BY ALL""")
def replace_touched_partitions(spark, folder):
    """Returned lines are re-priced to 0 by rewriting only their partitions."""
    path = scratch_dir(spark, "partitioned")
    parts = ["l_returnflag", "l_linestatus"]
    lines = catalog.table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").cast(MONEY).alias("price"), *parts
    )
    sinks.overwrite_partitions(lines, path, parts)
    returned = lines.where(F.col("l_returnflag") == "R").withColumn("price", F.lit(0).cast(MONEY))
    sinks.overwrite_partitions(returned, path, parts, only_touched=True)
    return sources.read_parquet(spark, path).groupBy(*parts).agg(F.count("*").alias("rows_kept"), F.sum("price").alias("total"))


@R.add("""SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, COUNT(*) AS orders_kept
    FROM orders GROUP BY ALL""")
def date_partitions(spark, folder):
    path = scratch_dir(spark, "by-month")
    sinks.write_partitioned(catalog.table(spark, folder, "orders"), path, "o_orderdate")
    return sources.read_parquet(spark, path).groupBy("year", "month").agg(F.count("*").alias("orders_kept"))


@R.add(f"""SELECT l_returnflag, COUNT(*) AS rows_kept,
    {sql.dbl(sql.total(f'CAST(l_extendedprice AS {sql.MONEY})'))} AS total FROM lineitem GROUP BY 1""")
def compact_small_files(spark, folder):
    many, few = scratch_dir(spark, "many-files"), scratch_dir(spark, "few-files")
    lines = catalog.table(spark, folder, "lineitem")
    sinks.overwrite(lines.repartition(40), many)
    sinks.compact(spark, many, few)
    kept = sources.read_parquet(spark, few)
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("rows_kept"), F.sum(F.col("l_extendedprice").cast(MONEY)).alias("total"))


@R.add("SELECT o_orderstatus, COUNT(*) AS rows_kept, 1 AS files FROM orders GROUP BY 1")
def compact_partitions(spark, folder):
    """Small files compacted inside the directories of a partitioned table."""
    many, few = scratch_dir(spark, "many-parts"), scratch_dir(spark, "few-parts")
    orders = catalog.table(spark, folder, "orders")
    orders.repartition(20).write.partitionBy("o_orderstatus").parquet(many)
    sinks.compact(spark, many, few, partition_columns=["o_orderstatus"])
    kept = sources.read_parquet(spark, few).withColumn("file", F.input_file_name())
    # One file for a small partition; larger tables get as many as their size asks for.
    return kept.groupBy("o_orderstatus").agg(
        F.count("*").alias("rows_kept"), F.least(F.lit(1), F.count_distinct("file")).cast("int").alias("files")
    )


@R.add("""
    WITH ends AS (SELECT MIN(o_totalprice) AS p0, MAX(o_totalprice) - MIN(o_totalprice) AS pw, MIN(o_orderkey) AS k0,
                         MAX(o_orderkey) - MIN(o_orderkey) AS kw FROM orders),
         b AS (SELECT (o_totalprice >= floor(p0 + pw / 4))::INT + (o_totalprice >= floor(p0 + pw / 2))::INT
                          + (o_totalprice >= floor(p0 + pw * 3 / 4))::INT AS p,
                      (o_orderkey >= floor(k0 + kw / 4))::INT + (o_orderkey >= floor(k0 + kw / 2))::INT
                          + (o_orderkey >= floor(k0 + kw * 3 / 4))::INT AS k FROM orders, ends)
    SELECT CAST((p & 1) + 2 * (k & 1) + 4 * (p >> 1) + 8 * (k >> 1) AS BIGINT) AS z, COUNT(*) AS orders_placed
    FROM b GROUP BY 1""")
def zorder_values(spark, folder):
    """Orders per cell of a grid of four by four, cut at quarters of the ranges that the data has."""
    orders, columns = catalog.table(spark, folder, "orders"), ["o_totalprice", "o_orderkey"]
    ends = orders.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).first()
    cuts = {c: [float(math.floor(ends[f"low_{c}"] + (ends[f"high_{c}"] - ends[f"low_{c}"]) * k / 4)) for k in (1, 2, 3)] for c in columns}
    return orders.groupBy(zvalue(orders, cuts, bits=2).alias("z")).agg(F.count("*").alias("orders_placed"))


@R.add(f"""SELECT o_orderstatus, COUNT(*) AS orders_kept, {sql.dbl(sql.total(f'CAST(o_totalprice AS {sql.MONEY})'))} AS total
    FROM orders GROUP BY 1""")
def zorder_rewrite(spark, folder):
    """The whole table clustered by date and customer, written, and read back."""
    path = scratch_dir(spark, "clustered")
    orders = catalog.table(spark, folder, "orders")
    sinks.overwrite(sinks.zorder(orders, ["o_orderdate", "o_custkey"], files=8), path)
    kept = sources.read_parquet(spark, path)
    return kept.groupBy("o_orderstatus").agg(F.count("*").alias("orders_kept"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"))


_BETWEEN = "l_partkey BETWEEN (SELECT MAX(l_partkey) // 4 FROM lineitem) AND (SELECT MAX(l_partkey) // 4 + MAX(l_partkey) // 20 FROM lineitem)"


@R.add(f"""SELECT CAST(year(l_shipdate) AS INT) AS year, COUNT(*) AS lines, {sql.dbl(sql.total(f'CAST(l_extendedprice AS {sql.MONEY})'))} AS total,
    TRUE AS few_files FROM lineitem WHERE {_BETWEEN} GROUP BY 1""")
def zone_pruned_lines(spark, folder):
    """Lines of a range of parts from a table clustered inside its years; the zone map leaves out over half of the files."""
    path, lines = scratch_dir(spark, "zones"), catalog.table(spark, folder, "lineitem")
    size = lines.agg(F.count("*").alias("n"), F.max("l_partkey").alias("top")).first()
    zones.write_clustered(lines, path, "l_shipdate", ["l_partkey", "l_suppkey"], ["year"], rows_per_file=max(1, size.n // 200))
    bounds = {"l_partkey": (size.top // 4, size.top // 4 + size.top // 20)}
    read, files = zones.chosen(spark, path, bounds)
    kept = zones.read_between(spark, path, bounds).groupBy("year")
    return kept.agg(
        F.count("*").alias("lines"), F.sum(F.col("l_extendedprice").cast(MONEY)).alias("total"), F.lit(2 * len(read) <= files).alias("few_files")
    )


@R.add("""SELECT o_orderstatus, COUNT(*) AS orders_kept FROM orders
    WHERE o_orderdate >= DATE '2001-08-02' - INTERVAL 730 DAY GROUP BY 1""")
def retained_orders(spark, folder):
    kept = sinks.retain(catalog.table(spark, folder, "orders"), "o_orderdate", 730, catalog.AS_OF)
    return gold.counts_by(kept, ["o_orderstatus"]).withColumnRenamed("count", "orders_kept")


# --- cleaning ---------------------------------------------------------------------------------


@R.add("SELECT role, COUNT(*) AS turns, CAST(SUM(length(trim(text))) AS BIGINT) AS characters FROM conversations GROUP BY 1")
def trimmed_text(spark, folder):
    talk = clean.trim_columns(catalog.table(spark, folder, "conversations"), ["role", "text"])
    return talk.groupBy("role").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("characters"))


@R.add(sql.query("rich", f"""SELECT COALESCE(payment_method, 'unknown') AS payment_method, COUNT(*) AS orders,
    {sql.dbl(f"CAST(SUM(COALESCE(payment_amount, 0)) AS {sql.MONEY})")} AS amount FROM rich GROUP BY 1"""))
def filled_defaults(spark, folder):
    filled = clean.fill_defaults(catalog.enriched(spark, folder), {"payment_method": "unknown", "payment_amount": 0})
    return filled.groupBy("payment_method").agg(F.count("*").alias("orders"), F.sum("payment_amount").alias("amount"))


@R.add(f"""SELECT o_orderstatus, {sql.dbl(sql.total(f'CAST(o_totalprice AS {sql.MONEY})'))} AS total,
    COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days, CAST(0 AS BIGINT) AS priorities, COUNT(*) AS cast_errors
    FROM orders GROUP BY 1""")
def typed_columns(spark, folder):
    text = catalog.table(spark, folder, "orders").select(
        "o_orderstatus",
        F.col("o_totalprice").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )
    kinds = {"o_totalprice": "decimal(18,2)", "o_orderdate": "date", "o_orderpriority": "int"}
    return clean.cast_columns(text, kinds).groupBy("o_orderstatus").agg(
        F.sum("o_totalprice").alias("total"), F.count_distinct("o_orderdate").alias("days"),
        F.count("o_orderpriority").alias("priorities"), F.sum("_cast_errors").alias("cast_errors"),
    )


@R.add("""SELECT p_partkey, upper(p_brand) AS p_brand, lower(p_type) AS p_type,
    array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS p_name FROM part""")
def cased_names(spark, folder):
    parts = catalog.table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return clean.normalise_case(parts, {"p_brand": "upper", "p_type": "lower", "p_name": "title"})


@R.add(sql.query("people", r"""SELECT country, regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')
    AS is_valid_email, COUNT(*) AS people FROM people GROUP BY ALL"""))
def email_flags(spark, folder):
    flagged = clean.email_flag(catalog.customers(spark, folder), "email")
    return flagged.groupBy("country", "is_valid_email").agg(F.count("*").alias("people"))


@R.add("""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS place FROM lineitem) WHERE place = 1""")
def latest_lines(spark, folder):
    ties = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    latest = clean.latest_per_key(
        catalog.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", ties
    )
    return latest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")


@R.add("SELECT COUNT(*) AS lines, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS distinct_lines FROM lineitem")
def distinct_lines(spark, folder):
    return catalog.table(spark, folder, "lineitem").agg(
        F.count("*").alias("lines"), F.count_distinct("l_orderkey", "l_linenumber").alias("distinct_lines")
    )


@R.add("""SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL AND l_quantity > 45""")
def filtered_columns(spark, folder):
    """Filter and column subset; both reach the Parquet scan."""
    lines = catalog.table(spark, folder, "lineitem")
    wanted = (F.col("l_returnflag") == "R") & F.col("l_orderkey").isNotNull() & (F.col("l_quantity") > 45)
    unused = [c for c in lines.columns if c not in ("l_orderkey", "l_partkey", "l_quantity")]
    return clean.without_columns(lines.where(wanted), unused)


# --- computed columns -------------------------------------------------------------------------


@R.add(sql.query("lines", """SELECT order_status, COUNT(*) AS lines,
    CAST(CAST(SUM(unit_cents * quantity) AS BIGINT) AS DOUBLE) / 100.0 AS total FROM lines GROUP BY 1"""))
def line_totals(spark, folder):
    totalled = enrich.with_total(catalog.order_lines(spark, folder))
    return totalled.groupBy("order_status").agg(F.count("*").alias("lines"), F.sum("total_amount").alias("total"))


@R.add(sql.query("paid", "SELECT payment_method, payment_category, COUNT(*) AS payments FROM paid GROUP BY ALL"))
def payment_categories(spark, folder):
    labelled = enrich.with_payment_category(catalog.payments(spark, folder).drop("payment_category"))
    return labelled.groupBy("payment_method", "payment_category").agg(F.count("*").alias("payments"))


@R.add(sql.query("heads", """SELECT order_id, COALESCE(status = 'completed', FALSE) AS is_completed FROM heads"""))
def completed_flags(spark, folder):
    heads = catalog.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "F", " Completed ").otherwise(F.col("o_orderstatus")).alias("order_status"),
    )
    return enrich.with_completed_flag(heads).select("order_id", "is_completed")


@R.add("""SELECT CASE WHEN value > 1000 THEN 'high' WHEN value > 100 THEN 'medium' ELSE 'low' END AS category,
    COUNT(*) AS events FROM events GROUP BY 1""")
def amount_levels(spark, folder):
    levels = enrich.amount_level(catalog.table(spark, folder, "events"), "value")
    return levels.groupBy("category").agg(F.count("*").alias("events"))


@R.add(sql.query("people", """SELECT customer_id, CAST(DATE '2001-08-02' - registration_date AS INT) AS days_since_registration
    FROM people"""))
def registration_days(spark, folder):
    aged = enrich.days_until(
        catalog.customers(spark, folder), {"days_since_registration": "registration_date"}, catalog.AS_OF
    )
    return aged.select("customer_id", "days_since_registration")


# --- joins ------------------------------------------------------------------------------------


@R.add(sql.query("rich", f"""SELECT * REPLACE ({sql.dbl('total_amount')} AS total_amount,
    {sql.dbl('payment_amount')} AS payment_amount) FROM rich"""))
def enriched_orders(spark, folder):
    return catalog.enriched(spark, folder)


@R.add(sql.query("placed people", f"""SELECT country, COUNT(*) AS orders, {sql.dbl(sql.total('total_amount'))} AS total
    FROM placed JOIN people USING (customer_id) GROUP BY 1"""))
def orders_with_customers(spark, folder):
    joined = enrich.matching_rows(catalog.orders(spark, folder), catalog.customers(spark, folder), ["customer_id"])
    return joined.groupBy("country").agg(F.count("*").alias("orders"), F.sum("total_amount").alias("total"))


@R.add("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphan_orders(spark, folder):
    orders = catalog.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return quality.orphans(orders, "o_orderkey", catalog.table(spark, folder, "lineitem"), "l_orderkey")


@R.add("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def matched_orders(spark, folder):
    orders = catalog.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return quality.matched_rows(orders, "o_orderkey", catalog.table(spark, folder, "lineitem"), "l_orderkey")


_SUPPLIED = """SELECT s_nationkey, COUNT(*) AS lines, CAST(CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS BIGINT) AS quantity
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1"""


def _supply(spark, folder):
    lines = catalog.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_quantity").cast("int").alias("quantity")
    )
    return lines, catalog.table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")


def _by_nation(joined):
    return joined.groupBy("s_nationkey").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))


@R.add(_SUPPLIED)
def broadcast_join(spark, folder):
    lines, suppliers = _supply(spark, folder)
    return _by_nation(skew.broadcast_join(lines, suppliers, "s_suppkey"))


@R.add(_SUPPLIED)
def repartitioned_join(spark, folder):
    lines, suppliers = _supply(spark, folder)
    return _by_nation(skew.repartitioned_join(lines, suppliers, "s_suppkey", 16))


# Customers and suppliers of the lower half of the nations share one key, the others have their own.
_SHARED = "CASE WHEN {0}_nationkey < 13 THEN -1 ELSE {0}_nationkey END"


@R.add(f"""SELECT s_suppkey, COUNT(c_custkey) AS customers, {sql.dbl(sql.total(f'CAST(c_acctbal AS {sql.MONEY})'))} AS balance
    FROM supplier LEFT JOIN customer ON {_SHARED.format('c')} = {_SHARED.format('s')} GROUP BY 1""")
def grid_join(spark, folder):
    """Suppliers with all customers of their key; one key holds half of both sides."""
    customers = catalog.table(spark, folder, "customer").selectExpr("c_custkey", f"CAST(c_acctbal AS {sql.MONEY}) AS balance", f"{_SHARED.format('c')} AS key")
    suppliers = catalog.table(spark, folder, "supplier").selectExpr("s_suppkey", f"{_SHARED.format('s')} AS key")
    size = suppliers.count()
    # All pairs would grow with the product of both tables; customers of a cell meet its suppliers as one row.
    sums = {"customers": F.count("c_custkey"), "balance": F.sum("balance")}
    met = skew.grid_join(suppliers, customers, "key", target=max(1, size // 10), partial=sums)
    return met.groupBy("s_suppkey").agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"), F.sum("balance").cast("decimal(28,2)").alias("balance"))


@R.add("""WITH kinds AS (SELECT event_type, COUNT(*) AS kind_size, CAST(MIN(value) AS DOUBLE) AS least FROM events GROUP BY 1)
    SELECT e.event_id, e.event_type, k.kind_size, k.least FROM events e LEFT JOIN kinds k USING (event_type)""")
def salted_join(spark, folder):
    """Events joined to their type, where every type is a hot key."""
    events = catalog.table(spark, folder, "events").select("event_id", "event_type", "value")
    kinds = events.groupBy("event_type").agg(F.count("*").alias("kind_size"), F.min("value").alias("least"))
    return skew.salted_join(events, kinds, "event_type", factor=8).drop("value")


@R.add("""WITH c AS (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1)
    SELECT event_type, n FROM c WHERE n >= 0.2 * (SELECT SUM(n) FROM c)""")
def hot_keys(spark, folder):
    return skew.hot_keys(catalog.table(spark, folder, "events"), "event_type", share=0.2)


@R.add(f"""WITH c AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1),
    s AS (SELECT CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) AS unique_keys, MAX(n) AS max_count,
                 CAST(median(n) AS DOUBLE) AS median_count FROM c)
    SELECT *, {sql.ratio('max_count * 2', 'CAST(median_count * 2 AS BIGINT)', 2)} AS skew_ratio,
           max_count > 10 * median_count AS has_skew FROM s""")
def skew_diagnosis(spark, folder):
    return skew.diagnose(catalog.table(spark, folder, "orders"), "o_custkey")


@R.add("SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def top_keys(spark, folder):
    return skew.top_keys(catalog.table(spark, folder, "orders"), "o_custkey", 10)


@R.add()
def partition_balance(spark, folder):
    return skew.partition_balance(catalog.table(spark, folder, "lineitem").repartition(16, "l_orderkey"))


# --- sketches ---------------------------------------------------------------------------------


def _order_sketches(spark, folder, **columns):
    """Sketches of the orders, stored in one batch per status and read again."""
    path, orders = scratch_dir(spark, "sketches"), catalog.table(spark, folder, "orders")
    for number, status in enumerate("FOP"):
        sketches.save(sketches.sketched(orders.where(F.col("o_orderstatus") == status), ["o_orderpriority"], **columns), path, number)
    return orders, sketches.stored(spark, path)


@R.add("""SELECT o_orderpriority, COUNT(*) AS orders_seen, COUNT(DISTINCT o_custkey) AS customers, TRUE AS close
    FROM orders GROUP BY 1""")
def sketched_distinct(spark, folder):
    """Customers per priority from merged sketches, next to the exact numbers: within three standard errors."""
    orders, kept = _order_sketches(spark, folder, distinct=["o_custkey"])
    found = sketches.estimated(sketches.merged(kept, ["o_orderpriority"]))
    exact = orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"))
    apart = F.abs(F.col("n_o_custkey") - F.col("customers"))
    close = apart <= F.greatest(F.lit(1.0), 3 * sketches.distinct_error() * F.col("customers"))
    return found.join(exact, ["o_orderpriority"]).select("o_orderpriority", F.col("rows").alias("orders_seen"), "customers", close.alias("close"))


@R.add("""SELECT COUNT(*) AS orders_seen, share, TRUE AS close FROM orders, (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99])::DOUBLE AS share) GROUP BY ALL""")
def sketched_quantiles(spark, folder):
    """Quantiles of all prices from merged sketches: their exact ranks lie within the error."""
    orders, kept = _order_sketches(spark, folder, quantiles=["o_totalprice"])
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = sketches.estimated(sketches.merged(kept), {"o_totalprice": shares})
    pairs = found.select(F.explode(F.arrays_zip(F.array(*[F.lit(s) for s in shares]).alias("share"), F.col("q_o_totalprice").alias("q"))).alias("e"))
    # Five values against all orders: the ranks come from one pass.
    values = [r[0] for r in pairs.select("e.q").collect()]
    below = orders.agg(F.count("*").alias("n"), *[F.avg((F.col("o_totalprice") <= v).cast("double")).alias(f"r{i}") for i, v in enumerate(values)])
    rows = [F.struct(F.lit(s).alias("share"), (F.abs(F.col(f"r{i}") - s) <= 3 * sketches.rank_error()).alias("close")) for i, s in enumerate(shares)]
    return below.select(F.col("n").alias("orders_seen"), F.inline(F.array(*rows)))


@R.add("""SELECT event_type, COUNT(*) AS events FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def sketched_top_keys(spark, folder):
    """The most frequent event types from the merged sketches of all days."""
    events = catalog.table(spark, folder, "events")
    kept = sketches.sketched(events.withColumn("day", F.to_date("ts")), ["day"], frequent=["event_type"])
    found = sketches.estimated(sketches.merged(kept), top=5).select(F.explode("top_event_type").alias("e"))
    return found.select(F.col("e.item").alias("event_type"), F.col("e.count").alias("events"))
