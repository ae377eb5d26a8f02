from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.operators import sketches


@pytest.fixture(scope="module")
def made(spark):
    i = F.col("id")
    return spark.range(0, 60_000, numPartitions=6).select(
        (i % 3).cast("int").alias("batch_no"), (i % 4).cast("int").alias("g"), (i % 9_000).alias("user"),
        F.when(i % 10 > 0, (i * 7919) % 60_000).cast("double").alias("v"),
        F.when(i % 4 == 0, F.lit("hot")).when(i % 5 == 0, F.lit("warm")).otherwise(F.concat(F.lit("k"), (i % 5_000).cast("string"))).alias("item"),
    )


def _stored(spark, made, path):
    for number in range(3):
        part = sketches.sketched(made.where(F.col("batch_no") == number), ["g"], ["user"], ["v"], ["item"])
        for _ in range(2 if number == 1 else 1):
            sketches.save(part, path, number)
    return sketches.stored(spark, path)


def test_merged_sketches_stay_within_their_errors(spark, made, tmp_path):
    kept = _stored(spark, made, str(tmp_path / "s"))
    assert kept.count() == 12
    row = sketches.estimated(sketches.merged(kept), {"v": [0.1, 0.5, 0.9]}, top=2).first()
    assert row.rows == 60_000 and abs(row.n_user - 9_000) <= 3 * sketches.distinct_error() * 9_000
    total = made.where("v IS NOT NULL").count()
    for share, value in zip([0.1, 0.5, 0.9], row.q_v, strict=True):
        assert abs(made.where(F.col("v") <= value).count() / total - share) <= 3 * sketches.rank_error()
    (hot, n_hot), (warm, n_warm) = row.top_item
    assert (hot, warm) == ("hot", "warm")
    slack = sketches.count_error() * 60_000
    assert abs(n_hot - 15_000) <= slack and abs(n_warm - made.where("item = 'warm'").count()) <= slack


def test_groups_and_spans_of_batches(spark, made, tmp_path):
    _stored(spark, made, str(tmp_path / "s"))
    span = sketches.stored(spark, str(tmp_path / "s"), 1, 1)
    assert {f.split("batch=")[1][0] for f in span.inputFiles()} >= {"1"} and rows(span.select("batch").distinct()) == [(1,)]
    found = sketches.estimated(sketches.merged(span, ["g"]))
    exact = made.where("batch_no = 1").groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("user").alias("u"))
    for r in found.join(exact, ["g"]).collect():
        assert r.rows == r.n and abs(r.n_user - r.u) <= max(1, 3 * sketches.distinct_error() * r.u)


def test_nothing_to_sketch(spark):
    none = spark.createDataFrame([(None, None)], "user int, v double")
    row = sketches.estimated(sketches.sketched(none, [], ["user"], ["v"])).first()
    assert (row.rows, row.n_user, row.q_v) == (1, 0, None)
