from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tests.conftest import plan
from tests.llm import brute
from tidewell.llm import bpe, fingerprints, licences, mixing, neardup, shingles, suffix

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_mix_places_copies_as_systematic_sampling_does(spark):
    rows = mixing.placed_copies(mixing.sized(brute.frame(spark))).collect()
    assert len(rows) == len(brute.awkward())
    by_source = defaultdict(list)
    for row in rows:
        by_source[row.source].append(row)
    sizes = {s: sum(r.size for r in group) for s, group in by_source.items()}
    weights = dict(zip([*sorted(s for s in sizes if s is not None), None], [3, 1, 2, 3], strict=False))
    target, open_ = {}, set(sizes)
    left = 1.5 * sum(sizes.values())
    while True:
        share = {s: weights[s] * left / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        open_ -= over
    target |= share
    for source, group in by_source.items():
        assert all(abs(r.target - target[source]) < 1e-6 and r.source_size == sizes[source] and 0 <= r.copies <= 2 for r in group)
        assert abs(sum(r.copies * r.size for r in group) - target[source]) <= 2 * max(r.size for r in group)


def test_mix_returns_rows_with_their_columns(spark):
    docs = brute.frame(spark)
    placed = Counter()
    for row in mixing.placed_copies(mixing.sized(docs)).collect():
        placed[row.doc_id] += row.copies
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +placed
    assert mixing.mix(brute.empty(spark)).isEmpty()


def test_bpe_equals_the_public_library_and_decodes(spark):
    docs, ranks = brute.frame(spark), bpe.read_ranks(spark, PATH)
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, out="tokens", decoded="bytes")
    assert coded.columns == [*docs.columns, "tokens", "bytes"]
    decoded = bpe.decode(coded, ranks, ids="tokens")
    seen = Counter()
    for row in decoded.collect():
        assert row.tokens == encoding.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == bytes(row.bytes) == (row.text or "").encode()
        seen[row.text] += 1
    assert seen == Counter(r[1] for r in brute.awkward())
    assert bpe.coded_digests(brute.empty(spark), PATH, public_tokenizers.PATTERN).isEmpty()
    strange = spark.createDataFrame([([10**6, -1, 64],), (None,)], "ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(strange, ranks).collect()] == [encoding.decode_bytes([64]), b""]


def test_bpe_puts_a_chunk_together_in_blocks_and_keeps_no_texts(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 50)
    ranks = bpe.read_ranks(spark, PATH)
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = [None, "", *(" ".join(f"w{rng.randrange(900)}é" for _ in range(rng.choice([0, 1, 30, 2000]))) for _ in range(60)), None]
    batch = pa.record_batch({"_row": pa.StructArray.from_arrays([pa.array(range(len(texts)))], ["doc_id"]), "_text": pa.array(texts, pa.string())})
    with pa.ipc.new_stream(sink := pa.BufferOutputStream(), batch.schema) as writer:
        writer.write_batch(batch)
    received = pa.ipc.open_stream(sink.getvalue()).read_next_batch()
    chunk = bpe._Chunk(regex.compile(public_tokenizers.PATTERN))
    chunk.add(received)
    assert received.column("_row").field(0).buffers()[1].address != chunk.rows[0].field(0).buffers()[1].address
    lists = pa.list_(batch.column("_row").type)
    schema = pa.schema({"chunk": pa.int64(), "rows": lists, "sequence": pa.binary(), "shard": pa.int32(), "words": pa.binary()})
    made, *words = chunk.emit(0, 3, schema)
    shards, coded = [], []
    for part in words:
        (lengths,), joined = bpe._unpack(part.column("words")[0].as_py())
        ends = np.cumsum(lengths).tolist()
        ids = [encoding.encode_ordinary(joined[a:b].decode()) for a, b in itertools.pairwise([0, *ends])]
        shards.append(part.column("shard")[0].as_py())
        coded.append(bpe._pack(np.array([len(x) for x in ids]), np.array(list(itertools.chain(*ids)))))
    answers = pa.table({"shard": pa.array(shards, pa.int32()), "coded": pa.array(coded, pa.binary())})
    whole = bpe._assembled(pa.Table.from_batches([made]), answers, False, bpe.token_table(ranks))
    assert whole.column("_row").to_pylist() == [{"doc_id": i} for i in range(len(texts))]
    assert whole.column("ids").to_pylist() == [encoding.encode_ordinary(t or "") for t in texts]
    assert whole.column("decoded").to_pylist() == [(t or "").encode() for t in texts]
    # No batch has texts that end in more than one block of words.
    sizes = [len(regex.findall(public_tokenizers.PATTERN, t or "")) for t in texts]
    assert len(whole.to_batches()) == len({end // 50 for end in itertools.accumulate(sizes)}) > 5


def test_shingle_hashes_tell_shingles_apart():
    texts = [None if t is None else t.encode() for _, t, *_ in brute.awkward()]
    hashes, offsets = shingles.shingle_hashes(texts, 3)
    for text, start, end in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert len(set(hashes[start:end].tolist())) == len(brute.shingles(text and text.decode(), 3))


def test_fingerprints_estimate_similarity(spark):
    docs = spark.createDataFrame(brute.awkward()[:19], brute.SCHEMA)
    rows = {r.doc_id: r for r in fingerprints.edited_likeness(docs).collect()}
    texts = [t or "" for _, t, *_ in brute.awkward()[:19]]
    for i, (text, after) in enumerate(zip(texts, [*texts[1:], texts[0]], strict=True)):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(text), brute.sha(edited.encode()))
        for estimate, other in ((rows[i].near_edited, edited), (rows[i].near_next, after)):
            a, b = brute.shingles(text, 5), brute.shingles(other, 5)
            assert abs(estimate - (len(a & b) / len(a | b) if a | b else 1)) < 0.15
    assert rows[9].fingerprint == rows[12].fingerprint and rows[0].fingerprint == rows[2].fingerprint == b""
    whole = fingerprints.edited_likeness(brute.frame(spark)).collect()
    assert len(whole) == len(brute.awkward())
    assert fingerprints.edited_likeness(brute.empty(spark)).isEmpty()
    one = fingerprints.edited_likeness(docs.limit(1)).collect()
    assert len(one) == 1
    pair = docs.where("doc_id IN (9, 12)").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    assert pair.select(fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b")))).head()[0] == 1


def test_a_settled_crowd_is_not_copied_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    # Bucket 1: a crowd of 40 and six others, one of them alone with its label; bucket 2: small; bucket 3: one label.
    labels = {1: [7] * 40 + [8, 8, 8, 9, 9, 10], 2: [7, 8, 8], 3: [7] * 9}
    members = [(key, 100 * key + i, label) for key, held in labels.items() for i, label in enumerate(held)]
    dealt = neardup._dealt(spark.createDataFrame(members, "key long, id long, label long")).collect()
    met = Counter()
    groups = {}
    for r in dealt:
        groups.setdefault((r.key, r._low, r._high), []).append(r)
    for (key, low, high), rows in groups.items():
        assert len({r._own for r in rows}) <= 2
        among = low if high in (low, rows[0]._lower) else None
        for a, b in itertools.combinations(rows, 2):
            if a.label != b.label and (a._own != b._own or a._own == among):
                met[key, *sorted((a.id, b.id))] += 1
    want = {(k, i, j) for (k, i, x), (l, j, y) in itertools.combinations(members, 2) if k == l and x != y}
    assert set(met) == want and set(met.values()) == {1}
    # 40 of the crowd go to two blocks of others; six others to one another's and ten blocks of the crowd.
    assert Counter(r.key for r in dealt) == {1: 40 * 2 + 6 * (1 + 10), 2: 3}


@pytest.mark.parametrize("block", [4, 512])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(5)
    texts = [t for _, t, *_ in brute.awkward()]
    # A chain whose ends are not similar, and a dense group with members at the edge of similarity.
    chain = brute.WORDS[:100]
    for i in range(12):
        texts.append(" ".join(chain))
        chain = chain[4:] + [f"new{i}a", f"new{i}b", f"new{i}c", f"new{i}d"]
    for _ in range(60):
        words = brute.WORDS[200:300]
        for at in rng.sample(range(100), rng.choice([1, 2, 3])):
            words = [*words[:at], f"other{rng.randrange(9)}", *words[at + 1 :]]
        texts.append(" ".join(words))
    ids = [None if i % 17 == 3 else i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    want = Counter(zip(ids, brute.components(texts, ids, 4), strict=True))
    assert Counter((r.doc_id, r.component_id) for r in neardup.groups(docs, words=4).collect()) == want


def test_one_document_of_each_group_stays(spark):
    docs = brute.frame(spark)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    texts, ids = zip(*[(r[1], r[0]) for r in brute.awkward()], strict=True)
    groups = brute.components(texts, ids, 5)
    wordless = sum(not brute.shingles(t, 5) for t in texts)
    assert kept.count() == len({g for g, t in zip(groups, texts, strict=True) if brute.shingles(t, 5)}) + wordless
    assert neardup.one_of_each(brute.empty(spark)).isEmpty()


@pytest.mark.parametrize("hot", [2, 2_000])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    rows = [(i, t) for i, (_, t, *_) in enumerate(brute.awkward()[:-5])]
    rows += [(100 + i, f"{i * 7919:x} " + brute.PASSAGE + f" {i * 104729:x} tail") for i in range(8)]
    found = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    want = {i: kept for (i, _), kept in zip(rows, brute.kept_bytes([t for _, t in rows]), strict=True)}
    assert len(found) == len(rows)
    for row in found:
        assert (bytes(row.kept), row.n_removed, row.n_spans) == want[row._row.doc_id]
    assert len(suffix.without_repeats(brute.frame(spark), ["doc_id", "ids"]).collect()) == len(brute.awkward())
    assert suffix.without_repeats(brute.empty(spark), ["doc_id"]).isEmpty()


def test_hot_keys_are_broadcast(spark, monkeypatch):
    """A join that shuffles would deal the bytes of all rows once more than sorting does."""
    monkeypatch.setattr(suffix, "HOT", 2)
    rows = [(i, f"{i * 7919:x} " + brute.PASSAGE + f" {i * 104729:x} tail") for i in range(8)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = plan(suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string").select("text")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [key" in found and "LeftAnti" in found
    assert not [line for line in found.splitlines() if "SortMergeJoin" in line and "LeftAnti" in line]


def test_buckets_stay_whole_where_joins_are_split(spark, monkeypatch):
    """Joins that shuffle, and partitions that all count as skewed."""
    monkeypatch.setattr(suffix, "HOT", 20)
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(1, 9))) for _ in range(300)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    passage = some(200)
    rows = []
    for i in range(900):
        at = rng.randrange(len(passage) - 210)
        rows.append((i, f"{some(3)} {passage[at : at + rng.randint(200, 600)]} {some(rng.randint(0, 30))}"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "24",
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.files.openCostInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
        found = {r._row.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in suffix.without_repeats(docs, ["doc_id"]).collect()}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert found == {i: kept for (i, _), kept in zip(rows, brute.kept_bytes([t for _, t in rows]), strict=True)}


def test_suffix_blocks_find_equal_windows():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 4):
        parts = [rng.integers(97, 97 + letters, n).astype(np.uint8).tobytes() for n in (200, 250, 420, 300)]
        parts += [parts[2][:260] + b"z", b"ab" * 150]
        starts = np.concatenate([np.arange(len(p) - 199) + sum(map(len, parts[:i])) for i, p in enumerate(parts)])
        block = b"".join(parts)
        counts = Counter(block[s : s + 200] for s in starts)
        assert suffix.repeated_windows(block, starts).tolist() == [counts[block[s : s + 200]] > 1 for s in starts]


def test_licences_by_spelling_case_and_copyright(spark):
    mit = next(text for name, text in licences.TEXTS if name == "MIT")
    written = "Copyright (c) 2020 Someone\n\n" + mit.upper().replace("SUBLICENSE", "sub-licence").replace("\n", "\n\n  ")
    rows = [(1, written), (1, written), (2, "x\nlicenced under cc by nc 4.0\nReleased under the MIT Licence!"), (3, None), (None, ""), (4, mit + " more")]
    found = Counter(tuple(r) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), licences.known(spark)).collect())
    assert found[(1, 4 - 1, "MIT", "")] == 2
    assert found[(2, 3, None, "CC-BY-NC-4.0,MIT")] == found[(3, 0, None, "")] == found[(None, 0, None, "")] == 1
    assert found[(4, 3, None, "")] == 1
    assert licences.scan(brute.empty(spark), licences.known(spark)).isEmpty()
