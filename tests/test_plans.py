from __future__ import annotations

import datetime
import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.compare import TABLES, differences
from tests.conftest import DATA, plan, rows
from tidewell import catalog
from tidewell.operators import clean, gold, quality
from tidewell.plans import ALL, medallion
from tidewell.sources import read_parquet


@pytest.fixture(scope="module")
def db():
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return made


@pytest.mark.parametrize("name", sorted(ALL.queries))
def test_query_matches_its_sql(spark, db, name):
    frame = ALL.queries[name](spark, DATA)
    found = frame.columns, [tuple(r) for r in frame.collect()]
    assert found[1]
    if name in ALL.oracles:
        result = db.execute(ALL.oracles[name])
        assert differences(found, ([c[0] for c in result.description], result.fetchall())) is None


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.queries().keys() >= entry.oracle_sql().keys()
    assert entry.entry(spark).count() > 0


def test_no_query_multiplies_tables(spark):
    for name in ("enriched_orders", "executive_summary", "hot_keys", "rule_results", "feature_table", "score_drift"):
        text = plan(ALL.queries[name](spark, DATA))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = plan(ALL.queries["filtered_columns"](spark, DATA))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(l_returnflag,R)" in text and "GreaterThan(l_quantity,45.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text
    daily = plan(gold.daily_revenue(catalog.enriched(spark, DATA)))
    assert "c_name" not in daily and "o_orderpriority" not in daily


def test_latest_row_is_limited_before_the_shuffle(spark):
    text = plan(clean.latest_per_key(catalog.table(spark, DATA, "lineitem"), ["l_orderkey"], "l_shipdate"))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]


def test_ranks_of_a_large_table_use_no_single_task_window(spark):
    text = plan(gold.top_products(catalog.order_lines(spark, DATA), one_task_rows=0, slots=8))
    windows = re.findall(r"Window \[.*", text)
    whole = [w for w in windows if "_slot" not in w]
    assert windows and not whole


def _scans(df) -> list[str]:
    """The tables a plan reads, one entry for each scan."""
    return re.findall(r"FileScan parquet.*?Location: [^\[]*\[[^\]]*/([\w.-]+?)[\],]", plan(df))


def test_joined_orders_are_evaluated_once(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        given = lambda name: [s for s in _scans(ALL.queries[name](spark, DATA)) if s.endswith(".parquet")]
        # The enriched orders read five tables, the lines two more.
        assert len(given("executive_summary")) <= 7 and len(given("enriched_orders")) == 5
        # Rules and combined features read a stored copy; of the given tables, references and lines are left.
        assert len(given("rule_results")) <= 2 and len(given("combined_features")) <= 2
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_reused_group_partitioning(spark):
    """Feature groups are joined on the key they are aggregated by, without moving them again."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from tidewell.operators import features

        lines = catalog.order_lines(spark, DATA).withColumn("payment_method", F.lit("x"))
        text = plan(features.behavioural(lines))
        assert text.count("Exchange hashpartitioning(customer_id") <= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_layers_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("orders", "customers", "payments"):
        (raw / name).mkdir(parents=True)
    (raw / "orders" / "a.csv").write_text(
        "order_id,customer_id,product_id,quantity,unit_price,order_date,status\n"
        " o1 ,c1,p1,2,29.99,2024-01-15, Completed\n"
        "o2,c2,p2,1,149.99,2024-01-15,completed\n"
        "o3,c1,p3,3,9.99,2024-01-16,pending\n"
        "o4,,p1,1,29.99,2024-01-16,completed\n"
        "o5,c3,p2,-1,149.99,2024-01-17,completed\n"
        "o6,c3,p2,,149.99,2024-01-17,completed\n"
        "o7,c2,p2,1,1.00,2024-01-17,odd\n"
    )
    (raw / "customers" / "a.csv").write_text(
        "customer_id,name,email,country,registration_date\n"
        "c1,juan GARCIA,JUAN@email.com,argentina,2023-06-15\n"
        "c2,Maria Lopez,maria@email.com,Mexico,2023-07-20\n"
        "c3,Carlos R,invalid-email,Colombia,bad date\n"
    )
    payments = [
        {"payment_id": "y1", "order_id": "o1", "amount": 40.0, "payment_method": "Credit_Card", "payment_date": "2024-01-15", "status": "COMPLETED"},
        {"payment_id": "y2", "order_id": "o1", "amount": 19.98, "payment_method": "paypal", "payment_date": "2024-01-16", "status": "completed"},
    ]
    (raw / "payments" / "a.json").write_text(json.dumps(payments, indent=1))
    root = str(tmp_path / "lake")
    paths = {name: str(raw / name) for name in ("orders", "customers", "payments")}
    written = medallion.run(spark, paths, root, datetime.date(2024, 1, 28))
    # A second delivery of the same files changes no silver or gold table.
    medallion.run(spark, paths, root, datetime.date(2024, 1, 28), batch_id="again")
    assert len(written) == len(set(written))
    read = lambda name: read_parquet(spark, f"{root}/{name}")
    assert read("bronze/orders").count() == 14 and read("silver/orders").count() == 7
    held = {r.order_id: tuple(r.reasons) for r in read("silver/quarantine").collect()}
    assert held == {"o4": ("valid_customer",), "o5": ("valid_total",), "o6": ("valid_total",), "o7": ("valid_status",)}
    juan = read("silver/customers").where("customer_id = 'c1'").first()
    assert (juan.name, juan.email, juan.country, juan.is_valid_email) == ("Juan Garcia", "juan@email.com", "Argentina", True)
    day = read("gold/daily_revenue").first()
    assert (day.total_orders, float(day.gross_revenue), float(day.collected_revenue)) == (2, 209.97, 59.98)
    assert read("gold/customer_360").count() == 2
    results = quality.validate(read("silver/orders"), quality.positive("quantity") + quality.not_null("customer_id"))
    assert rows(results.select("failed_records")) == [(1,), (1,)]
