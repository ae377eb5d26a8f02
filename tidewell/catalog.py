"""The given tables seen as orders, order lines, customers, payments and events.

Fixed values below define the view; ``plans`` holds the same view in SQL.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import labels
from tidewell.operators import enrich

# The day after the last order, and two moments inside the event stream.
AS_OF = datetime.date(2001, 8, 2)
EVENTS_CUT = datetime.datetime(2024, 1, 15)
EVENTS_LATE = datetime.datetime(2024, 1, 20)
STATUS = {"F": labels.COMPLETED, "O": labels.PENDING, "P": labels.CANCELLED}
METHODS = {
    "1-URGENT": "credit_card",
    "2-HIGH": "debit_card",
    "3-MEDIUM": "paypal",
    "4-NOT SPECIFIED": "bank_transfer",
    "5-LOW": "cash",
}
OPERATIONS = {"signup": "INSERT", "error": "DELETE"}
FIRST_REGISTRATION = datetime.date(1994, 1, 1)


# Schemas of the given tables; with them a read needs no look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _case(value: str, mapping: dict[str, str], default: str | None = None) -> str:
    """The mapping as SQL text."""
    branches = " ".join(f"WHEN '{key}' THEN '{name}'" for key, name in mapping.items())
    return f"CASE {value} {branches} {f"ELSE '{default}'" if default else ''} END"


_STATUS = _case("o_orderstatus", STATUS)
# Line prices are doubles with two decimals and never negative: whole cents keep them exact.
_CENTS = "CAST(FLOOR(l_extendedprice * 100 + 0.5D) AS BIGINT)"
_UNITS = "CAST(l_quantity AS INT)"


def _headers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        f"{_STATUS} AS status",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order that has lines: quantity and amount summed over its lines."""
    sums = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.expr(f"SUM({_UNITS}) AS quantity"),
            F.expr(f"CAST(CAST(SUM({_CENTS}) AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(18,2)) AS total_amount"),
        )
    )
    return _headers(spark, folder).join(sums, ["order_id"])


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, with product and unit price."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS line_number",
        "l_partkey AS product_id",
        f"{_UNITS} AS quantity",
        f"CAST(CAST({_CENTS} AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(18,2)) AS total_amount",
        f"CAST(CAST(({_CENTS} * 2 + {_UNITS}) DIV ({_UNITS} * 2) AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(18,2)) AS unit_price",
    )
    return lines.join(_headers(spark, folder).withColumnRenamed("status", "order_status"), ["order_id"])


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their country; customers in debt have an address of a wrong shape."""
    nation = table(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS country")
    local = "IF(c_acctbal < 0, LOWER(c_name), REPLACE(LOWER(c_name), '#', '.'))"
    return (
        table(spark, folder, "customer")
        .join(nation, ["c_nationkey"], "left")
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS name",
            f"CONCAT({local}, '@', LOWER(c_mktsegment), '.com') AS email",
            "country",
            f"DATE_ADD(DATE '{FIRST_REGISTRATION}', CAST(c_custkey % 365 AS INT)) AS registration_date",
        )
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order that was not cancelled."""
    method = _case("o_orderpriority", METHODS)
    return (
        table(spark, folder, "orders")
        .where("o_orderstatus <> 'P'")
        .selectExpr(
            "o_orderkey AS payment_id",
            "o_orderkey AS order_id",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
            f"{method} AS payment_method",
            f"{_case(method, labels.PAYMENT_CATEGORIES, 'other')} AS payment_category",
            "CAST(o_orderdate AS DATE) AS payment_date",
            f"{_STATUS} AS status",
        )
    )


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enriched_orders(orders(spark, folder), customers(spark, folder), payments(spark, folder))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event table in the shape of the event stream."""
    return as_events(table(spark, folder, "events"))


_NUMBER = "CAST(GET_JSON_OBJECT(props, '$.k') AS INT)"


def as_events(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "event_type",
        "CAST(user_id AS STRING) AS user_id",
        f"CONCAT('P', {_NUMBER}) AS product_id",
        "value AS amount",
        f"{_NUMBER} AS quantity",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "props AS metadata",
    )


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a file stream, be it one file or a folder of parts.

    The pattern in the name makes the stream look for the table among its siblings: a file is taken as it is, a folder
    with all its parts. Without any, Spark refuses to start.
    """
    raw = spark.readStream.schema(SCHEMAS["events"]).parquet(f"{folder}/events.parque[t]")
    return as_events(raw)


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as changes of users: sign-ups insert, errors delete, all others update."""
    return as_changes(table(spark, folder, "events"))


def as_changes(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "user_id",
        "CAST(value AS DECIMAL(18,2)) AS balance",
        "event_type AS status",
        f"{_case('event_type', OPERATIONS, 'UPDATE')} AS operation",
        "event_id",
        "ts AS updated_at",
    )
