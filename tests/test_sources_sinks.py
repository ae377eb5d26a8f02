from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows, same
from tidewell import sinks, sources
from tidewell.sinks import layout
from tidewell.sinks.layout import zvalue

SCHEMA = "id string, quantity int, price double"


def test_csv_keeps_bad_rows_in_sight(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,quantity,price\na,1,2.5\nb,many,3\nc,2,4\n")
    df = sources.read_csv(spark, str(tmp_path), SCHEMA)
    assert df.count() == 3
    assert [r.id for r in df.where(F.col("_corrupt_record").isNull()).orderBy("id").collect()] == ["a", "c"]
    report = sources.bad_rows(df).first()
    assert (report.total_records, report.corrupt_records) == (3, 1)


def test_csv_infers_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,quantity,day\na,1,2024-01-15\n")
    assert dict(sources.read_csv(spark, str(tmp_path)).dtypes) == {"id": "string", "quantity": "int", "day": "date"}


def test_json_documents_and_lines(spark, tmp_path):
    records = [{"id": "a", "quantity": 1, "price": 2.5}, {"id": "b", "quantity": 2, "price": None}]
    (tmp_path / "doc").mkdir()
    (tmp_path / "doc" / "a.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(map(json.dumps, records)) + "\n{broken\n")
    whole = sources.read_json(spark, str(tmp_path / "doc"), SCHEMA, multi_line=True)
    lines = sources.read_json(spark, str(tmp_path / "lines"), SCHEMA)
    assert rows(whole.select("id", "quantity")) == [("a", 1), ("b", 2)]
    assert rows(lines.where("id IS NOT NULL").select("id", "quantity")) == [("a", 1), ("b", 2)]
    assert lines.cache().where("_corrupt_record IS NOT NULL").count() == 1
    assert "price" in sources.read_json(spark, str(tmp_path / "doc"), multi_line=True).columns


def test_audit_columns(spark, data):
    df = sources.with_audit(sources.read_parquet(spark, f"{data}/nation.parquet"), "b7")
    row = sources.with_constants(df, {"_is_fictional_data": True}).first()
    assert row._source_file.endswith("nation.parquet")
    assert (row._batch_id, row._is_fictional_data) == ("b7", True)
    assert row._ingestion_timestamp is not None
    assert sources.with_audit(spark.range(1)).first()._source_file == ""


def test_append_evolves_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1,)], "a int"), path)
    sinks.append(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert rows(sources.read_parquet(spark, path, merge_schema=True)) == [(1, None), (2, "x")]
    sinks.overwrite(spark.createDataFrame([("z",)], "c string"), path)
    assert rows(sources.read_parquet(spark, path)) == [("z",)]


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"], only_touched=True)
    assert rows(sources.read_parquet(spark, path)) == [(1, "a"), (9, "b")]
    sinks.overwrite_partitions(spark.createDataFrame([(7, "c")], "v int, p string"), path, ["p"])
    assert rows(sources.read_parquet(spark, path)) == [(7, "c")]


def test_date_partitions_prune(spark, data, tmp_path):
    path = str(tmp_path / "t")
    orders = sources.read_parquet(spark, f"{data}/orders.parquet")
    sinks.write_partitioned(orders, path, "o_orderdate", max_records_per_file=50)
    read = sources.read_parquet(spark, path)
    assert read.count() == orders.count()
    chosen = read.where("year = 1998 AND month = 3")
    assert "PartitionFilters: [isnotnull(year" in plan(chosen)
    assert chosen.count() == orders.where("date_trunc('month', o_orderdate) = date'1998-03-01'").count()
    biggest = read.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert biggest <= 50


def test_compact(spark, tmp_path):
    many, few = str(tmp_path / "many"), str(tmp_path / "few")
    df = spark.range(1000).repartition(20)
    df.write.parquet(many)
    sinks.compact(spark, many, few, target_files=2)
    assert len(spark.read.parquet(few).inputFiles()) == 2
    assert same(spark.read.parquet(few), df)
    sized = str(tmp_path / "sized")
    sinks.compact(spark, many, sized)
    assert len(spark.read.parquet(sized).inputFiles()) < 20
    with pytest.raises(ValueError):
        sinks.compact(spark, many, many + "/")


def test_compact_keeps_partitions(spark, tmp_path):
    many, few = str(tmp_path / "many"), str(tmp_path / "few")
    df = spark.range(300).withColumn("part", F.col("id") % 3).repartition(10)
    df.write.partitionBy("part").parquet(many)
    sinks.compact(spark, many, few, partition_columns=["part"])
    files = spark.read.parquet(few).inputFiles()
    assert len(files) == 3 and all("/part=" in f for f in files)
    assert same(spark.read.parquet(few).selectExpr("id", "CAST(part AS BIGINT) part"), df)


def test_text_cuts_follow_the_rows(spark):
    df = spark.range(6_400).selectExpr("IF(id % 2 = 0, 'm', LPAD(CAST(id AS STRING), 5, '0')) AS t")
    cuts = layout.zorder_cuts(df, ["t"], bits=3)["t"]
    assert 3 <= len(cuts) <= 7 and cuts == sorted(cuts)
    assert layout.zorder_cuts(df.limit(0), ["t"], bits=3)["t"] == []


def test_zvalue_interleaves_bits(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 2), (None, 3)], "a int, b int")
    cuts = {"a": [1, 2, 3], "b": [1, 2, 3]}
    found = [r.z for r in df.select(zvalue(df, cuts, bits=2).alias("z")).collect()]
    assert found == [0, 1, 2, 0b1101, 0b1010]


def test_zorder_cuts_of_empty_columns(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 2, None)], "a int, b int, c string")
    cuts = sinks.zorder_cuts(df, ["a", "b", "c"], bits=2)
    assert cuts["a"] == [] and cuts["c"] == [] and cuts["b"]


def test_zorder_narrows_every_file(spark, tmp_path):
    path = str(tmp_path / "z")
    df = spark.range(20_000).select(
        (F.col("id") * 7919 % 10_007).alias("a"),
        F.date_add(F.lit(datetime.date(2020, 1, 1)), (F.col("id") * 104_729 % 1_009).cast("int")).alias("d"),
        F.concat(F.lit("CUST_"), F.format_string("%05d", F.col("id") * 31 % 9_973)).alias("c"),
    )
    clustered = sinks.zorder(df, ["a", "d", "c"], files=27, bits=4)
    sinks.overwrite(clustered, path)
    read = spark.read.parquet(path)
    assert same(read, df)
    spans = read.groupBy(F.input_file_name()).agg((F.max("a") - F.min("a")).alias("s"), (F.datediff(F.max("d"), F.min("d"))).alias("t"))
    mean = spans.agg(F.avg("s"), F.avg("t")).first()
    assert mean[0] < 0.65 * 10_007 and mean[1] < 0.65 * 1_009


def test_retention_boundary(spark):
    days = [datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), datetime.date(2024, 1, 31), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = sinks.retain(df, "d", 29, datetime.date(2024, 1, 31))
    assert {r.d for r in kept.collect()} == {datetime.date(2024, 1, 2), datetime.date(2024, 1, 31), None}
