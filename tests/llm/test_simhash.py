from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import brute
from tidewell.llm import simhash
from tidewell.llm.neardup import components

RING = (1 << 64) - 1


def fingerprint(text: str | None, words: int = 3) -> int:
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(prints: list[int]) -> dict[int, int]:
    """The number of each distinct fingerprint's group, by comparing all pairs."""
    distinct = np.array(sorted(set(prints)), np.uint64)
    above = list(range(len(distinct)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, one in enumerate(distinct):
        for j in (np.flatnonzero(np.bitwise_count(distinct[i + 1 :] ^ one) <= 2) + i + 1).tolist():
            above[top(j)] = top(i)
    return {int(p): top(i) for i, p in enumerate(distinct)}


def crowded() -> list[int]:
    """Dense groups around centres that differ in few bits, chains, borders of segments, and strangers."""
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    made = [centre ^ sum(1 << b for b in rng.sample(range(40, 64), rng.choice([1, 2, 3, 4]))) for _ in range(1_500)]
    made += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 5]))) for _ in range(600)]
    chain = rng.getrandbits(64)
    for _ in range(80):
        chain ^= sum(1 << b for b in rng.sample(range(64), 2))
        made.append(chain)
    lone = rng.getrandbits(64)
    made += [lone] + [rng.getrandbits(64) for _ in range(300)]
    made += [lone ^ (1 << a) ^ (1 << b) for a, b in [(0, 63), (8, 9), (27, 28), (53, 54)]]
    return [*made, 0, 1, RING, RING ^ 3, RING ^ 7]


@pytest.mark.parametrize("run", [3, 256])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, run):
    monkeypatch.setattr(simhash, "RUN", run)
    prints = crowded()
    want = groups(prints)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in set(prints)]
    found = spark.createDataFrame(signed, "fingerprint long").repartition(7)
    links = simhash.links(found)
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).isEmpty()
    label = {r.id & RING: r.label & RING for r in components(links).collect()}
    got: dict[int, set] = {}
    for p in want:
        got.setdefault(label.get(p, p), set()).add(p)
    expected: dict[int, set] = {}
    for p, group in want.items():
        expected.setdefault(group, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_every_pair_within_the_bits_has_a_chain():
    segments = simhash._segments(0)
    assert sum(segments) == RING and len(segments) == simhash.SEGMENTS
    rng = random.Random(2)
    first = simhash.levels()[0]
    for _ in range(2_000):
        apart = sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2])))
        assert any(not apart & mask and all((apart & bits).bit_count() <= most for bits, most in budgets) for mask, budgets in first)


@pytest.mark.parametrize("block", [5, 100_000])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "SHINGLE_BLOCK", block)
    base = brute.WORDS[:300] * 4
    texts = [r[1] for r in brute.awkward()] + [" ".join([*base[:i], "other", *base[i + 1 :]]) for i in range(0, 1_200, 24)]
    assert [simhash.simhash(t and t.encode()) & RING for t in texts] == [fingerprint(t) for t in texts]
    ids = [None if i in (1, 30) else i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").withColumn("fingerprint", F.lit("x"))
    found = simhash.groups(docs.repartition(3)).collect()
    group = groups([fingerprint(t) for t in texts])
    least: dict[int, int] = {}
    for i, text in zip(ids, texts, strict=True):
        if i is not None:
            least[group[fingerprint(text)]] = min(i, least.get(group[fingerprint(text)], i))
    want = Counter((i, fingerprint(t), least.get(group[fingerprint(t)])) for i, t in zip(ids, texts, strict=True))
    assert len(set(least.values())) < len(set(texts))
    assert Counter((r.doc_id, r.fingerprint & RING, r.component_id) for r in found) == want
    assert simhash.groups(brute.empty(spark)).isEmpty()
    one = spark.createDataFrame([(0, None), (None, "")], "doc_id long, text string")
    shown = simhash.groups(one).select(simhash.hexed(F.col("fingerprint")).alias("f"), "component_id").collect()
    assert [tuple(r) for r in shown] == [("0" * 16, 0)] * 2
