from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tests.conftest import same
from tidewell import sinks
from tidewell.sinks import store, zones

BOUNDS = {"a": (200, 260), "b": (None, 300)}


def _rows(spark, count=4_000, start=0):
    made = spark.range(start, start + count).select(
        F.date_add(F.lit(datetime.date(2024, 1, 1)), (F.col("id") % 70).cast("int")).alias("day"),
        ((F.col("id") * 7919) % 1000).cast("int").alias("a"), ((F.col("id") * 104729) % 997).cast("int").alias("b"), "id",
    )
    return made.withColumn("a", F.when(F.col("id") % 50 > 0, F.col("a")))


def _wanted(rows):
    return rows.where("a BETWEEN 200 AND 260 AND b <= 300")


def test_zone_map_leaves_out_files_and_no_rows(spark, tmp_path):
    path, rows = str(tmp_path / "t"), _rows(spark)
    zones.write_clustered(rows, path, "day", ["a", "b"], rows_per_file=50)
    stored = spark.read.parquet(path)
    assert same(stored.select(rows.columns), rows)
    files, known = zones.chosen(spark, path, BOUNDS)
    assert 0 < 3 * len(files) < known == len(stored.inputFiles())
    found = zones.read_between(spark, path, BOUNDS)
    assert set(found.inputFiles()) == set(files) and same(found.select(rows.columns), _wanted(rows))
    # A bound on the date meets the zones of the date, and so the directories.
    day = datetime.date(2024, 2, 20)
    assert all("/month=2/" in f for f in zones.chosen(spark, path, {"day": (day, day)})[0])
    assert zones.read_between(spark, path, {"a": (5_000, None)}).isEmpty()


def test_rows_written_later_are_never_missed(spark, tmp_path):
    path, rows, more = str(tmp_path / "t"), _rows(spark), _rows(spark, 300, start=10_000)
    zones.write_clustered(rows, path, "day", ["a", "b"], rows_per_file=100)
    dated = more.withColumns({"year": F.year("day"), "month": F.month("day")})
    dated.write.mode("append").partitionBy("year", "month").parquet(path)
    everything = rows.union(more)
    unmapped = zones.chosen(spark, path, BOUNDS)[0]
    assert same(zones.read_between(spark, path, BOUNDS).select(rows.columns), _wanted(everything))
    before = zones.zones(spark, path).count()
    zones.refresh(spark, path, ["day", "a", "b"])
    assert zones.zones(spark, path).count() == len(spark.read.parquet(path).inputFiles()) > before
    assert len(zones.chosen(spark, path, BOUNDS)[0]) < len(unmapped)
    assert same(zones.read_between(spark, path, BOUNDS).select(rows.columns), _wanted(everything))
    # Replaced partitions: the map forgets their files.
    sinks.overwrite_partitions(dated.where("month = 2"), path, ["year", "month"], only_touched=True)
    left = spark.read.parquet(path)
    assert same(zones.read_between(spark, path, BOUNDS).select(rows.columns), _wanted(left.select(rows.columns)))
    zones.refresh(spark, path, ["day", "a", "b"])
    assert zones.zones(spark, path).count() == len(left.inputFiles())
    assert same(zones.read_between(spark, path, BOUNDS).select(rows.columns), _wanted(left.select(rows.columns)))


def test_tables_without_a_map_are_read_whole(spark, tmp_path):
    path, rows = str(tmp_path / "t"), _rows(spark, 100)
    rows.write.parquet(path)
    assert zones.zones(spark, path) is None
    assert same(zones.read_between(spark, path, BOUNDS), _wanted(rows))
    zones.refresh(spark, path, ["id"])
    assert store.read_text(spark, f"{path}/_zones/current") == "v1"
    # A bound on a column that is not mapped leaves no file out.
    assert len(zones.chosen(spark, path, BOUNDS)[0]) == zones.chosen(spark, path, BOUNDS)[1]
