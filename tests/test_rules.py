from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell.operators import quality
from tidewell.streaming.rules import RuleState

NOW = datetime.datetime(2024, 2, 1)
SCHEMA = "id int, who string, v int"


def _rules(spark, known):
    table = spark.createDataFrame([(k,) for k in known], "who string")
    return quality.not_null("id") + quality.unique("id") + quality.unique("who") + quality.positive("v") + quality.references("who", table, "who")


def _made(rng, count):
    return [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b", "c", "d", "e"]), rng.choice([None, -1, 0, 5])) for _ in range(count)]


def test_batches_come_to_the_rules_of_the_whole(spark, tmp_path):
    rng, arrived = random.Random(4), []
    state = RuleState(spark, str(tmp_path), _rules(spark, []), buckets=4)
    keys = lambda number, *values: state.add_keys("who", spark.createDataFrame([(v,) for v in values], "who string"), number, NOW)
    keys(0, "a", "b", None)
    known = ["a", "b"]
    for number, size in enumerate([30, 1, 25]):
        made = _made(rng, size)
        arrived += made
        for _ in range(2 if number == 2 else 1):
            state.add(spark.createDataFrame(made, SCHEMA), number, NOW)
        assert same(state.results(), quality.validate(spark.createDataFrame(arrived, SCHEMA), _rules(spark, known)))
        if number == 1:
            # Keys that arrive late take back the orphans that waited for them; known ones change nothing.
            for _ in range(2):
                keys(1, "c", "a", "z")
            known += ["c", "z"]
            assert same(state.results(), quality.validate(spark.createDataFrame(arrived, SCHEMA), _rules(spark, known)))
    assert sorted(r.step for r in state.history().select("step").distinct().collect()) == ["keys-who-0", "keys-who-1", "rows-0", "rows-1", "rows-2"]
    per_step = state.history().where("rule_name = 'not_null'").groupBy("step").agg(F.max("total_records").alias("n"))
    assert dict(rows(per_step))["rows-2"] == 56


@pytest.mark.parametrize("broken", ["_count", "_moved"])
def test_a_batch_that_died_is_counted_once(spark, tmp_path, monkeypatch, broken):
    made = _made(random.Random(1), 40)
    state = RuleState(spark, str(tmp_path), _rules(spark, ["a"]), buckets=4)
    state.add_keys("who", spark.createDataFrame([("a",)], "who string"), 0, NOW)
    state.add(spark.createDataFrame(made[:20], SCHEMA), 0, NOW)
    with monkeypatch.context() as patched:
        patched.setattr(state, broken, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.add(spark.createDataFrame(made[20:], SCHEMA), 1, NOW)
    state.add(spark.createDataFrame(made[20:], SCHEMA), 1, NOW)
    assert same(state.results(), quality.validate(spark.createDataFrame(made, SCHEMA), _rules(spark, ["a"])))


def test_an_empty_batch_counts_nothing(spark, tmp_path):
    state = RuleState(spark, str(tmp_path), _rules(spark, []), buckets=2)
    state.add(spark.createDataFrame([], SCHEMA), 0, NOW)
    state.add(spark.createDataFrame([(1, "a", 1)], SCHEMA), 1, NOW)
    assert rows(state.results().select("rule_name", "failed_records")) == [
        ("not_null", 0), ("positive", 0), ("referential_integrity", 1), ("unique", 0), ("unique", 0),
    ]
