from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm import brute
from tidewell.llm import bpe, mixing, toxicity

DATA = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def test_all_queries_are_registered():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert {n for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in queries)} == set(range(1, 11))
    assert "pipeline" in queries and {"op2_mix", "op6_licences"} <= oracles.keys()


@pytest.fixture(scope="module")
def documents(spark):
    more = brute.frame(spark).withColumn("doc_id", F.col("doc_id") + 10_000)
    return spark.read.parquet(f"{DATA}/documents.parquet").unionByName(more, allowMissingColumns=True).cache()


def _texts(df) -> list[tuple]:
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_toxic_documents_go(spark, documents):
    kept = STAGES["toxicity"](spark, documents, DATA)
    model = toxicity.learn(documents, spark.read.parquet(f"{DATA}/labels.parquet"))
    scored = toxicity.score(documents, model).where("predicted = 0")
    assert kept.columns == documents.columns
    assert Counter(_texts(kept)) == Counter(_texts(scored))


def test_one_of_each_group_stays(spark, documents):
    kept = STAGES["near_duplicates"](spark, documents, DATA)
    assert kept.columns == documents.columns
    before, after = _texts(documents), _texts(kept)
    groups = brute.components([t for _, t in before], [i for i, _ in before], 5)
    named = {g for g, (_, t) in zip(groups, before, strict=True) if brute.shingles(t, 5)}
    wordless = [i for i, t in before if not brute.shingles(t, 5)]
    assert sorted(map(str, (i for i, t in after if brute.shingles(t, 5)))) == sorted(map(str, named))
    assert Counter(i for i, t in after if not brute.shingles(t, 5)) == Counter(wordless)


def test_repeats_are_cut_from_texts(spark, documents):
    cut = STAGES["repeated_passages"](spark, documents, DATA)
    assert cut.columns == documents.columns
    before = _texts(documents)
    want = Counter(
        (i, None if t is None else kept.decode("utf-8", "ignore"))
        for (i, t), (kept, _, _) in zip(before, brute.kept_bytes([t for _, t in before]), strict=True)
    )
    assert Counter(_texts(cut)) == want
    assert cut.where(F.col("n_chars") != F.coalesce(F.char_length("text"), F.lit(0))).isEmpty()


def test_mix_repeats_documents(spark, documents):
    mixed = STAGES["mix"](spark, documents, DATA)
    assert mixed.columns == documents.columns
    copies = Counter()
    for row in mixing.placed_copies(mixing.sized(documents)).collect():
        copies[row.doc_id] += row.copies
    assert Counter(i for i, _ in _texts(mixed)) == +copies


def test_tokens_round_trip(spark, documents):
    ranks = bpe.read_ranks(spark, corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY))
    tokens = bpe.decode(STAGES["tokens"](spark, documents, DATA), ranks).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in tokens) == Counter((i, (t or "").encode()) for i, t in _texts(documents))
    assert all(r.decoded_sha256 == brute.sha(bytes(r.decoded)) and r.n_tokens == len(r.ids) for r in tokens)


def test_whole_pipeline(spark, tmp_path):
    made = corpus_pipeline.run(spark, DATA)
    assert made.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"] and not made.isEmpty()
    folder = str(tmp_path)
    spark.read.parquet(f"{DATA}/labels.parquet").limit(0).write.parquet(f"{folder}/labels.parquet")
    spark.read.parquet(f"{DATA}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).isEmpty()
