from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidewell.llm import merkle

FANOUT = merkle.FANOUT
UPPER = {i: i + 32 for i in range(65, 91)}


def leaf(row: tuple) -> str:
    doc_id, text, lang, source, n_chars = row[:5]
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return brute.sha("".join(parts).encode())


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root of a row of nodes, and each node's siblings, level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            start = i - i % FANOUT
            path.append(("".join(level[start:i]), "".join(level[i + 1 : start + FANOUT])))
        level = [brute.sha("".join(level[i : i + FANOUT]).encode()) for i in range(0, len(level), FANOUT)]
        at = [i // FANOUT for i in at]
    return level[0], paths


def expected(rows: list[tuple]) -> Counter:
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    placed = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in order}
    trees = {s: climb([leaf(r) for r in placed[s]]) for s in order}
    root, tops = climb([trees[s][0] for s in order])
    found = []
    for source, top in zip(order, tops, strict=True):
        subroot, paths = trees[source]
        for row, path in zip(placed[source], paths, strict=True):
            steps = path + top
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None
            fold = leaf((row[0], row[1].translate(UPPER), *row[2:])) if changed else leaf(row)
            for left, right in steps:
                fold = brute.sha((left + fold + right).encode())
            proof = brute.sha("".join(left + right for left, right in steps).encode())
            found.append((row[0], leaf(row), subroot, root, proof, fold, fold == root))
    return Counter(found)


def many() -> list[tuple]:
    """A crowded source of over two blocks, a source of exactly a run, lone sources; and the awkward rows."""
    rows = [(i, f"Text {i}", "en", "hot", i) for i in range(4_200)]
    rows += [(5_000 + i, f"T{i}", None, "sixteen", None) for i in range(16)]
    rows += [(6_000 + i, "lone", "x", f"s{i}", 1) for i in range(40)]
    return rows


@pytest.mark.parametrize("height", [1, 3])
def test_manifest_equals_trees_in_python(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = [r[:5] for r in brute.awkward()] + many()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    found = merkle.verified(docs).collect()
    assert Counter(tuple(r) for r in found) == expected(rows)
    assert {r.verified for r in found} == {True, False}


def test_manifest_with_clashing_columns_and_small_tables(spark):
    names = ["_pos", "_n", "_node", "_steps", "steps", "root", "leaf", "_group", "altered"]
    docs = brute.frame(spark).withColumns({c: F.lit("x") for c in names})
    assert Counter(tuple(r) for r in merkle.verified(docs).collect()) == expected([r[:5] for r in brute.awkward()])
    assert merkle.verified(brute.empty(spark)).isEmpty()
    one = merkle.verified(brute.frame(spark).where("doc_id = 5")).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == brute.sha(b"")


def test_a_proof_shows_any_change(spark):
    leaves = spark.createDataFrame([(i, "a", brute.sha(str(i).encode())) for i in range(300)], "id long, part string, node string")
    done = merkle.manifest(leaves, "part", ["id"], "node")
    other = merkle.digest(F.col("node"))
    assert done.columns == ["id", "part", "node", "steps", "subroot", "root"]
    clashing = leaves.withColumnRenamed("id", "_pos").withColumnsRenamed({"part": "_n", "node": "root"}).withColumn("_row", F.lit(1))
    assert merkle.manifest(clashing, "_n", ["_pos"], "root").select("root").distinct().count() == 1
    checked = done.select((merkle.folded(F.col("node"), F.col("steps")) == F.col("root")).alias("right"), (merkle.folded(other, F.col("steps")) == F.col("root")).alias("wrong"))
    assert {tuple(r) for r in checked.collect()} == {(True, False)}
