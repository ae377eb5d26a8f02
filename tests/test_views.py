from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell.operators import cdc, gold
from tidewell.streaming import views

NOW = datetime.datetime(2024, 2, 1)
AS_OF = datetime.date(2024, 3, 1)
SCHEMA = (
    "order_id int, customer_id int, customer_name string, customer_email string, customer_country string, order_date date, "
    "order_status string, quantity long, total_amount decimal(18,2), payment_amount decimal(18,2), registration_date date"
)
FULL = {
    "daily_revenue": (gold.daily_revenue, views.daily_revenue),
    "country_revenue": (gold.country_revenue, views.country_revenue),
    "customer_360": (lambda df: gold.customer_360(df, AS_OF), lambda df: views.customer_360(df, AS_OF)),
}


def _order(rng: random.Random, key: int) -> tuple:
    """An order with NULLs here and there; a customer's own columns follow from its number."""
    who = rng.choice([None, 1, 1, 1, 2, 3, 4])
    day = rng.choice([None, *[datetime.date(2024, 1, d) for d in (1, 2, 3, 9)]])
    money = lambda: rng.choice([None, Decimal(rng.randrange(1, 9_000)) / 100])
    registered = None if who in (None, 4) else datetime.date(2023, who, 1)
    name = None if who is None else f"n{who}"
    return (
        key, who, name, name and name + "@x", [None, "a", "b", None, "c"][who or 0], day, rng.choice(["completed", "completed", "pending", "cancelled", None]),
        rng.choice([None, 1, 2]), money(), money(), registered,
    )


@pytest.mark.parametrize("view", views.VIEWS, ids=lambda v: v.name)
def test_views_follow_inserts_updates_and_deletes(spark, tmp_path, view):
    rng, held = random.Random(3), {}
    before = spark.createDataFrame([], SCHEMA)
    full, shown = FULL[view.name]
    for number, size in enumerate([60, 25, 25, 5]):
        if number == 3:
            # All of what is left of one day, one country and one customer goes.
            held = {k: r for k, r in held.items() if r[5] != datetime.date(2024, 1, 9) and r[4] != "c" and r[1] != 2}
        else:
            for key in rng.sample(range(90), size):
                held.pop(key, None)
                if number == 0 or rng.random() < 0.7:
                    held[key] = _order(rng, key)
        after = spark.createDataFrame(list(held.values()), SCHEMA)
        feed = cdc.snapshot_diff(before, after, ["order_id"])
        for _ in range(2 if number == 1 else 1):
            views.refresh(str(tmp_path), view, feed, NOW, number=number, buckets=4)
        kept = views.read(spark, str(tmp_path), view, 4)
        assert same(kept, views.whole(after, view))
        assert same(shown(kept), full(after))
        before = after


def test_refresh_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    orders = spark.createDataFrame([_order(random.Random(i), i) for i in range(40)], SCHEMA)
    view, root = views.COUNTRY, str(tmp_path)
    broken = views.View(view.name, view.group, view.partials, lambda parts: 1 / 0, view.where)
    with pytest.raises(ZeroDivisionError):
        views.refresh(root, broken, views.as_inserts(orders), NOW, number=0, buckets=4)
    views.refresh(root, view, views.as_inserts(orders), NOW, number=0, buckets=4)
    assert same(views.read(spark, root, view, 4), views.whole(orders, view))


def test_only_touched_groups_are_made_again(spark, tmp_path):
    orders = spark.createDataFrame([_order(random.Random(i), i) for i in range(200)], SCHEMA)
    root, view = str(tmp_path), views.DAILY
    views.refresh(root, view, views.as_inserts(orders), NOW, number=0, buckets=16)
    day = F.lit(datetime.date(2024, 1, 2))
    more = orders.where("customer_id = 1").limit(1).withColumns({"order_id": F.lit(999), "order_date": day, "order_status": F.lit("completed")})
    views.refresh(root, view, views.as_inserts(more), NOW, number=1, buckets=16)
    partials, figures = views._tables(spark, root, view, 16)
    wanted = [r[0] for r in more.select(figures.bucket(more)).collect()]
    assert figures.rewritten(2) == partials["buyers"].rewritten(2) == wanted
    everything = orders.unionByName(more)
    assert same(views.daily_revenue(views.read(spark, root, view, 16)), gold.daily_revenue(everything))


def test_a_feed_without_matching_rows(spark, tmp_path):
    none = spark.createDataFrame([_order(random.Random(1), 1)], SCHEMA).withColumn("order_status", F.lit("pending"))
    views.refresh(str(tmp_path), views.DAILY, views.as_inserts(none), NOW, number=0, buckets=4)
    with pytest.raises(FileNotFoundError):
        views.read(spark, str(tmp_path), views.DAILY, 4)
    assert rows(views.whole(none, views.DAILY)) == []
