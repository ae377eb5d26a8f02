from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, same
from tidewell.operators import gold
from tidewell.plans import layers, medallion
from tidewell.sources import read_parquet

AS_OF = datetime.date(2024, 1, 28)
HEADS = {
    "orders": "order_id,customer_id,product_id,quantity,unit_price,order_date,status",
    "customers": "customer_id,name,email,country,registration_date",
}
# Deliveries: later ones change and complete earlier rows.
FIRST = {
    "orders": [
        " o1 ,c1,p1,2,29.99,2024-01-15, Completed", "o2,c2,p2,1,149.99,2024-01-15,pending", "o3,c1,p3,3,9.99,2024-01-16,pending",
        "o4,,p1,1,29.99,2024-01-16,completed", "o5,c3,p2,-1,149.99,2024-01-17,completed", ",c1,p1,1,5.00,2024-01-17,completed",
    ],
    "customers": ["c1,juan GARCIA,JUAN@email.com,argentina,2023-06-15", "c2,Maria Lopez,maria@email.com,Mexico,2023-07-20"],
    "payments": [("y1", "o1", 40.0, "Credit_Card", "2024-01-15", "COMPLETED"), ("y2", "o1", 19.98, "paypal", "2024-01-16", "completed"), ("y9", None, 1.0, "cash", "2024-01-16", "completed")],
}
SECOND = {
    "orders": ["o2,c2,p2,2,149.99,2024-01-15,completed", "o6,c4,p9,x,1.00,bad,completed", "o7,c2,p2,1,1.00,2024-01-20,odd"],
    "customers": ["c3,Carlos R,invalid-email,Colombia,bad date", "c1,Juan Garcia,juan@email.com,Chile,2023-06-15"],
    "payments": [("y3", "o2", 100.0, "cash", "2024-01-18", "pending")],
}
THIRD = {
    "orders": ["o1,c1,p1,2,29.99,2024-01-15,cancelled", "o7,c2,p2,1,1.00,2024-01-20,completed"],
    "customers": ["c4,New One,new@email.com,Peru,2024-01-01"],
    # A payment that moves from one order to another.
    "payments": [("y2", "o3", 19.98, "paypal", "2024-01-16", "completed"), ("y3", "o2", 299.98, "cash", "2024-01-19", "completed")],
}


def _deliver(raw, number, made):
    for name, lines in made.items():
        (raw / name).mkdir(parents=True, exist_ok=True)
        if name == "payments":
            fields = ["payment_id", "order_id", "amount", "payment_method", "payment_date", "status"]
            text = "\n".join(json.dumps(dict(zip(fields, p, strict=True))) for p in lines)
        else:
            text = "\n".join([HEADS[name], *lines]) + "\n"
        (raw / name / f"d{number}.{layers.KINDS[name]}").write_text(text)


def _paths(raw):
    return {name: str(raw / name) for name in layers.KINDS}


def _full(spark, raw, root, monkeypatch):
    """The rebuild of everything; later files win, as they would by their time of arrival."""
    readers = medallion.READERS | {"payments": (*medallion.READERS["payments"][:2], {})}
    monkeypatch.setattr(medallion, "READERS", readers)
    for number in (1, 2, 3):
        paths = {name: f"{path}/d{number}.{layers.KINDS[name]}" for name, path in _paths(raw).items()}
        medallion.run(spark, paths, root, AS_OF, batch_id=str(number))
    return lambda name: read_parquet(spark, f"{root}/{name}")


def test_layers_from_new_files_equal_the_full_rebuild(spark, tmp_path, monkeypatch):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    sizes = []
    for number, made in enumerate((FIRST, SECOND, THIRD), 1):
        _deliver(raw, number, made)
        for _ in range(2 if number == 2 else 1):
            kept = layers.run(spark, _paths(raw), root, batch_id=str(number), buckets=4)
        sizes.append(max(kept.enriched.versions()))
    # A run without new files makes no version.
    assert sizes == [1, 2, 3]
    read = _full(spark, raw, str(tmp_path / "full"), monkeypatch)
    shown = kept.enriched.state()
    assert same(shown, read("silver/enriched_orders").select(shown.columns))
    valid, quarantined = kept.validated()
    assert same(valid.select("order_id"), read("silver/validated_orders").select("order_id"))
    assert same(quarantined.select("order_id", "reasons"), read("silver/quarantine").select("order_id", "reasons"))
    for name, table in kept.gold(AS_OF).items():
        full = read(f"gold/{name}")
        assert same(table.select(full.columns), full), name
    assert same(gold.daily_revenue(valid), kept.gold(AS_OF)["daily_revenue"])
    lost = {(r.source, r.record_key, tuple(r.reasons)) for r in kept.rejects().collect()}
    assert lost == {
        ("orders", None, ("no order_id",)), ("orders", "o6", ("corrupt record", "bad order_date")), ("customers", "c3", ("bad registration_date",)),
    }
    assert rows(kept.rejects().groupBy("source").count()) == [("customers", 1), ("orders", 2)]
    full_lost = read("silver/orders_rejects").select("record_key", "reasons")
    assert same(kept.rejects().where("source = 'orders'").select("record_key", "reasons"), full_lost)


def test_a_broken_run_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    _deliver(raw, 1, FIRST)
    with monkeypatch.context() as patched:
        patched.setattr(layers.Layers, "refresh_views", lambda self, at: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run(spark, _paths(raw), root, buckets=4)
    _deliver(raw, 2, SECOND)
    with monkeypatch.context() as patched:
        patched.setattr(layers.Layers, "enrich", lambda self, at: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run(spark, _paths(raw), root, buckets=4)
    kept = layers.run(spark, _paths(raw), root, buckets=4)
    valid, _ = kept.validated()
    assert rows(valid.select("order_id")) == [("o1",), ("o2",), ("o3",)]
    assert same(kept.gold(AS_OF)["daily_revenue"], gold.daily_revenue(valid))
    assert same(kept.gold(AS_OF)["customer_360"], gold.customer_360(valid, AS_OF))


def test_an_update_reads_only_its_buckets(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    _deliver(raw, 1, FIRST | {"orders": [f"o{i},c{i % 9},p1,1,5.00,2024-01-15,completed" for i in range(300)]})
    kept = layers.run(spark, _paths(raw), root, buckets=16)
    _deliver(raw, 2, {"orders": ["o7,c7,p1,2,5.00,2024-01-15,completed"]})
    seen = []
    of = layers.Layers._of

    def watched(self, table, keys):
        found = of(self, table, keys)
        seen.append({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f})
        return found

    layers.Layers._of, before = watched, of
    try:
        kept = layers.run(spark, _paths(raw), root, buckets=16)
    finally:
        layers.Layers._of = before
    assert seen and all(len(buckets) <= 1 for buckets in seen)
    assert len(kept.enriched.rewritten(2)) == 1
    assert kept.enriched.state().agg(F.sum("quantity")).first()[0] == 301
