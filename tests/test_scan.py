from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewell.operators import scan
from tidewell.operators.ordered import global_ranks

SCHEMA = "k string, j int, s int, v int"


def _made(seed):
    """Groups of one row and of hundreds, NULL keys and values, many ties."""
    rng = random.Random(seed)
    made = [(rng.choice(["a", "a", "a", "b", None, f"k{i}"]), rng.choice([1, 1, None]), i, rng.choice([None, 0, 1, 2])) for i in range(400)]
    rng.shuffle(made)
    return made


@pytest.mark.parametrize(("seed", "parts"), [(1, 1), (2, 7), (3, 60)])
def test_neighbours_and_running_sums_equal_python(spark, seed, parts):
    made = _made(seed)
    placed = scan.laid_out(spark.createDataFrame(made, SCHEMA).repartition(5), ["k", "j"], [F.col("s").desc()], parts)
    found = scan.with_neighbour(placed, ["k", "j"], ["s", "v"], "was")
    found = scan.with_neighbour(found, ["k", "j"], ["v"], "next", ahead=True, base=placed)
    found = scan.with_running(found, ["k", "j"], {"n": F.lit(1), "total": F.coalesce("v", F.lit(0))})
    want = []
    for key in {(k, j) for k, j, *_ in made}:
        mine = sorted((m for m in made if m[:2] == key), key=lambda m: -m[2])
        for i, m in enumerate(mine):
            was = mine[i - 1] if i else None
            after = mine[i + 1] if i + 1 < len(mine) else None
            want.append((*m, was and was[2], was and was[3], i and was is not None, after is not None, after and after[3], i + 1, sum(x[3] or 0 for x in mine[: i + 1])))
    shown = found.select("k", "j", "s", "v", "was.s", "was.v", F.col("was").isNotNull(), F.col("next").isNotNull(), "next.v", "n", "total")
    assert rows(shown) == sorted([(*w[:6], bool(w[6]), *w[7:]) for w in want], key=repr)


@pytest.mark.parametrize("parts", [1, 4, 30])
def test_ranks_equal_a_plain_window(spark, parts):
    df = spark.createDataFrame(_made(5), SCHEMA).repartition(3)
    ranked = scan.with_ranks(df, "v", "dense", "above", parts)
    values = sorted({m[3] for m in _made(5)}, key=lambda v: (v is None, -(v or 0)))
    counts = {v: sum(m[3] == v for m in _made(5)) for v in values}
    want = {v: (i + 1, sum(counts[u] for u in values[:i])) for i, v in enumerate(values)}
    assert {(r.v, (r.dense, r.above)) for r in ranked.collect()} == set(want.items())
    assert ranked.columns == [*df.columns, "dense", "above"]


def test_one_value_does_not_fill_a_partition(spark):
    df = spark.range(8_000).select(F.lit(7).alias("v"), F.lit("x").alias("k"))
    placed = scan.laid_out(df, ["k"], [F.desc_nulls_last("v")], parts=8)
    sizes = [r["count"] for r in placed.groupBy("_slot").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2_000
    same_rank = global_ranks(df, {"r": "v"}, {"p": "v"}, one_task_rows=0, slots=8)
    assert rows(same_rank.select("r", "p").distinct()) == [(1, 0.0)]
    text = plan(scan.with_running(placed, ["k"], {"n": F.lit(1)}))
    assert "BroadcastNestedLoopJoin" not in text and "SinglePartition" not in text.split("Window")[0]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert scan.with_ranks(none, "v", "d", "a", 3).isEmpty()
    placed = scan.laid_out(none, ["k"], [F.col("s")], 3)
    assert scan.with_running(scan.with_neighbour(placed, ["k"], ["v"], "was"), ["k"], {"n": F.lit(1)}).isEmpty()
