from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidewell.llm import curves, language, quality, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_every_language_is_learned_within_the_bounds(spark, monkeypatch):
    """300 languages of few texts and one of many: none is left out, and bytes are bounded."""
    rare = [(i * 100 + j, f"word{chr(0x4E00 + i)}{j} " * 5, f"l{i}") for i in range(300) for j in range(4)]
    docs = spark.createDataFrame(rare + [(100_000 + i, "plain text " * 30, "common") for i in range(1_000)], "doc_id long, text string, lang string")
    counts = language.label_counts(docs)
    found = language.examples(docs, counts)
    learnable = {r[2] for r in rare if zlib.crc32(str(r[0]).encode()) % 4 != 2} | {"common"}
    assert len(learnable) > 290 and {lang for lang, _, _ in found} == learnable == set(counts)
    assert 500 < sum(lang == "common" for lang, _, _ in found) < 700 < counts["common"][0]
    rest = sum(size for lang, (_, size) in counts.items() if lang != "common")
    monkeypatch.setattr(language, "SAMPLE_BYTES", 24 * (rest + 330 * 100))
    fewer = language.examples(docs, counts)
    assert 60 < sum(lang == "common" for lang, _, _ in fewer) < 140 and sum(lang != "common" for lang, _, _ in fewer) == len(found) - sum(lang == "common" for lang, _, _ in found)


def test_shares_of_the_corpus_are_put_back(spark):
    """Two languages that cannot be told apart: the corpus decides, whatever the sample's shares are."""
    bag = language.bag(b" same words ")
    sample = [("a", *bag), ("b", *bag)] * 40
    model = language.train(sample, counts={"a": 9_000, "b": 1_000})
    p = language._softmax(model.logits([b" same words "])[0].astype(float))
    assert 0.8 < p[model.languages.index("a")] < 0.95
    assert language.train(sample).languages == ["a", "b"]


def test_language_of_held_out_documents(spark, documents):
    model = language.train(language.examples(documents))
    found = language.predict(documents, model).where(language.held_out(F.col("doc_id")))
    right, total = found.agg(F.count(F.when(F.col("lang_pred") == F.col("lang"), 1)), F.count("lang")).head()
    assert total > 100 and right / total > 0.97
    rows = language.predict(brute.frame(spark), model).collect()
    assert len(rows) == len(brute.awkward())
    for row in rows:
        letters = any(map(str.isalpha, row.text or ""))
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
        assert letters or not row.accepted
    same = language.predict(spark.createDataFrame([("Le chat",), ("Le chat",)], "text string"), model).distinct()
    assert same.count() == 1
    assert language.predict(brute.empty(spark), model).isEmpty()
    nothing = language.predict(brute.frame(spark), language.train(language.examples(brute.empty(spark))))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_subwords_of_a_text_do_not_depend_on_its_neighbours():
    model = language.Model(["a", "b"], np.random.default_rng(1).normal(size=(1 << 16, 16)), np.eye(16)[:, :2], np.zeros(2), 1.0, 0.0)
    texts = [b" ab cd ", b"", b" x ", b" longer text here "]
    alone = np.concatenate([model.logits([t]) for t in texts])
    assert np.allclose(model.logits(texts), alone, atol=1e-4)
    for text, row in zip(texts, alone, strict=True):
        if text:
            buckets, shares = language.bag(text)
            assert np.allclose(shares @ model.embeddings[buckets] @ model.classifier, row, atol=1e-4)


def test_folding_undoes_disguises():
    assert toxicity.fold("1D10T, $tupid! іdіоt wor!d") == " idiot stupid idiot worid "
    assert toxicity.fold(None) == toxicity.fold("") == toxicity.fold(" \n") == "  "


def test_longest_entry_counts_and_exceptions_excuse():
    model = toxicity.Model({" bad": 1.0, " badly ": 3.0}, [" bad luck "], None)
    total = lambda text: np.expm1(toxicity.features(toxicity.fold(text), model.automaton())[2])
    assert [round(total(t), 6) for t in ("badly", "bad", "badge", "bad luck", "bad luck bad", "notbad")] == [3, 1, 1, 0, 1, 0]


def test_toxicity_of_held_out_documents(spark, documents, labels):
    model = toxicity.learn(documents, labels)
    held = toxicity.score(documents, model).where(toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] / (counts[1, 1] + counts.get((1, 0), 0)) > 0.6
    assert counts.get((0, 1), 0) / counts[0, 0] < 0.05
    rows = toxicity.score(brute.frame(spark), model).collect()
    assert len(rows) == len(brute.awkward()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.score(brute.empty(spark), model).isEmpty()
    odd = spark.createDataFrame([(1, None), (1, 7), (None, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(brute.frame(spark), toxicity.learn(brute.frame(spark), odd)).collect()} == {0.0}


def test_toxicity_decides_alike_when_the_sample_has_another_share_of_toxic_rows(spark, monkeypatch):
    """One word is in all 100 toxic and in a fifth of 2,000 clean texts: a fifth of the texts with it are toxic, not 5 in 6."""
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 21 == 0), " ".join([*(f"filler{chr(97 + n)}" for n in rng.integers(0, 26, 20)), *["grobian"] * (i % 21 == 0 or i % 5 == 0)])) for i in range(2_100)]
    docs = spark.createDataFrame([(i, text) for i, _, text in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, toxic, _ in rows], "doc_id long, toxic int")
    found = {}
    for size in (4_000, 200):
        monkeypatch.setattr(toxicity, "SAMPLE", size)
        found[size] = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    assert {i: r.predicted for i, r in found[4_000].items()} == {i: r.predicted for i, r in found[200].items()}
    with_word = [r.score for i, r in found[200].items() if "grobian" in rows[i][2]]
    assert 0.1 < np.mean(with_word) < 0.3


def _kneser_ney(texts: list[str]):
    """The probability of a gram by the textbook recursion, over dictionaries."""
    counts = {4: Counter(int(g) for g in quality.grams(texts)[0])}
    for order in (3, 2, 1):
        counts[order] = Counter(g & ((1 << 6 * order) - 1) for g in counts[order + 1])
    discounts = {}
    for order, table in counts.items():
        n = [sum(v == i for v in table.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        discounts[order] = [max(0.1, min(i, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]

    def p(order: int, gram: int) -> float:
        if not order:
            return 1 / 64
        siblings = {g: v for g, v in counts[order].items() if g >> 6 == gram >> 6}
        below = p(order - 1, gram & ((1 << 6 * (order - 1)) - 1))
        if not siblings:
            return below
        cut = lambda n: min(n, discounts[order][min(n, 3) - 1]) if n else 0
        own = siblings.get(gram, 0)
        return (own - cut(own) + sum(map(cut, siblings.values())) * below) / sum(siblings.values())

    return p


def test_kneser_ney_equals_the_recursion(spark):
    trusted, asked = ["abab abc abd.", "abcabd abe", "zz abab 1"], ["abab zzq", "abd abc Ä漢"]
    p = _kneser_ney(trusted)
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    made = quality.log_probabilities(quality._gram_counts(frame(trusted)), quality._gram_counts(frame(asked)).select("gram"))
    rows = made.collect()
    assert {r.gram for r in rows} == {int(g) for g in quality.grams(asked)[0]}
    assert all(abs(np.exp(r.logp) - p(4, r.gram)) < 1e-12 for r in rows)
    context = int(quality.grams(["ab"])[0][1]) >> 6
    assert abs(sum(p(4, context << 6 | w) for w in range(64)) - 1) < 1e-12
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    texts = [*trusted, *trusted, *asked]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    good = [texts[r.doc_id] for r in quality.trusted(labels).where("fit").collect()]
    p = _kneser_ney(good)
    for row in quality.scored(docs, labels).collect():
        found = quality.grams([texts[row.doc_id]])[0]
        assert abs(row.perplexity / np.exp(-np.mean([np.log(p(4, int(g))) for g in found])) - 1) < 1e-5


def _judged_by_characters(docs: list[tuple], trusted: dict[int, bool]) -> dict:
    """Perplexity and ``kept`` by dictionaries over grams of whole characters; ``trusted`` says which documents the model learns from."""
    marked = lambda text: "\0" * 3 + "".join(chr(ord(c) + 1) for c in text)
    of = lambda text: [marked(text)[i : i + 4] for i in range(len(text))]
    size = len({c for _, text, _ in docs for c in text or ""})
    counts = {4: Counter(g for i, text, _ in docs if trusted.get(i) for g in of(text))}
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    discounts, siblings = {}, {}
    for order, table in counts.items():
        n = [sum(v == i for v in table.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        discounts[order] = [max(0.1, min(i, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
        for gram, v in table.items():
            siblings.setdefault((order, gram[:-1]), []).append(v)

    def p(gram: str) -> float:
        order = len(gram)
        if not order:
            return 1 / size
        there = siblings.get((order, gram[:-1]))
        if not there:
            return p(gram[1:])
        cut = lambda n: min(n, discounts[order][min(n, 3) - 1]) if n else 0
        own = counts[order].get(gram, 0)
        return (own - cut(own) + sum(map(cut, there)) * p(gram[1:])) / sum(there)

    found = {i: np.exp(-np.mean([np.log(p(g)) for g in of(text)])) if text else None for i, text, _ in docs}
    bounds = {}
    for lang in {lang for _, _, lang in docs}:
        seen = sorted(found[i] for i, _, own in docs if own == lang and trusted.get(i) is False)
        bounds[lang] = (seen[0] / quality.MARGIN, seen[-1] * quality.MARGIN)
    return {i: (found[i], bool(text) and bounds[lang][0] <= found[i] <= bounds[lang][1]) for i, text, lang in docs}


def test_texts_of_any_script_are_told_from_rows_of_marks(spark, tmp_path, monkeypatch):
    """Every character counts: the query equals brute force over whole characters, with chunks and blocks of any size."""
    rng = np.random.default_rng(4)
    words = {
        "ru": "мир труд май дом лес река поле небо вода земля хлеб соль день ночь утро".split(),
        "zh": "天地 玄黄 宇宙 洪荒 日月 盈昃 辰宿 列张 寒来 暑往 秋收 冬藏".split(),
        "fr": "été éclair forêt naïf leçon où garçon âme œuvre 12 45 7".split(),
    }
    docs = []
    for lang, some in words.items():
        docs += [(len(docs) + i, " ".join(rng.choice(some, 40)), lang) for i in range(40)]
        docs += [(len(docs) + i, "".join(c if c == " " else "#" for c in " ".join(rng.choice(some, 40))), lang) for i in range(3)]
        docs += [(len(docs) + i, "".join(rng.permutation(list("".join(some) * 3))), lang) for i in range(3)]
    docs += [(len(docs), None, "ru"), (len(docs) + 1, "", "zh"), (len(docs) + 2, "я", "ru"), (len(docs) + 3, "🙂🙃 𐍈", "zh")]
    good = [(i, 1, 0) for i, text, lang in docs if text and set(text) <= set("".join(words[lang])) | {" "} and text.count(" ") == 39]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(good, "doc_id long, quality int, toxic int")
    frame.withColumns({"source": F.lit("x"), "n_chars": F.length("text")}).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    expected = _judged_by_characters(docs, {r.doc_id: r.fit for r in quality.trusted(labels).collect()})
    assert sum(kept for _, kept in expected.values()) > 100 and len(expected) == len(docs)
    for block, chunk in ((1_000_000, 16_000_000), (5, 700)):
        monkeypatch.setattr(quality, "BLOCK", block)
        monkeypatch.setattr(quality, "CHUNK", chunk)
        rows = quality.op9_quality(spark, str(tmp_path)).collect()
        assert len(rows) == len(docs)
        for row in rows:
            perplexity, kept = expected[row.doc_id]
            assert (row.perplexity is None) == (perplexity is None) and row.kept == kept, row
            assert perplexity is None or abs(row.perplexity / perplexity - 1) < 1e-5
    text = {i: t for i, t, _ in docs}
    assert not any(r.kept for r in rows if set(text[r.doc_id] or "#") <= {"#", " "})


def test_quality_keeps_clean_documents_and_drops_junk(spark, documents, labels):
    kept = quality.judged(documents, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    share = {r.quality: r.kept for r in kept.collect()}
    assert share[1] > 0.97 and share[0] < 0.5
    rows = quality.judged(brute.frame(spark), labels).collect()
    assert len(rows) == len(brute.awkward())
    assert all((r.perplexity is None) == (r.n_symbols == 0) and (r.n_symbols or not r.kept) for r in rows)
    assert quality.judged(brute.empty(spark), labels).isEmpty()
    assert not any(r.kept for r in quality.judged(brute.frame(spark), labels.limit(0)).collect())


def test_hilbert_order_steps_to_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = curves.hilbert(grid, 3)
    assert sorted(place.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("clustered", [True, False])
def test_nearest_reach_the_recall(spark, monkeypatch, clustered):
    monkeypatch.setattr(curves, "BLOCK", 64)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1_000, 16)) + (8 * rng.normal(size=(25, 16))[rng.integers(0, 25, 1_000)] if clustered else 0)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = curves.nearest(frame, frame.where("vec_id % 20 = 0"), k=10).collect()
    exact = np.array([v for _, v in rows])
    hits = 0
    for query in range(0, 1_000, 20):
        scores = exact @ exact[query]
        best = [i for i in np.lexsort([np.arange(1_000), -scores]) if i != query][:10]
        mine = [r for r in found if r.query_id == query]
        assert sorted(r.rank for r in mine) == list(range(1, 11))
        assert all(abs(r.score - scores[r.vec_id]) < 1e-9 for r in mine)
        hits += len({r.vec_id for r in mine} & set(best))
    assert hits / 500 >= 0.9


def test_nearest_with_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(0, 60)] + [(100, [0.0, 1.0]), (120, [0.5, 0.5])]
    rows += [(140, None), (160, []), (180, [0.0, 0.0]), (200, [nan, 1.0]), (220, [inf, 1.0]), (240, [None, 1.0]), (None, [1.0, 1.0]), (260, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found: dict[int, list] = {}
    for row in sorted(curves.nearest(frame, frame.where("vec_id % 20 = 0")).collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append(row.vec_id)
    assert set(found) == {0, 20, 40, 100, 120}
    assert found[0] == list(range(1, 21)) and found[20] == [*range(20)] and found[40] == [*range(20)]
    assert found[100] == [120, *range(19)] and found[120] == [*range(20)]
    assert curves.nearest(frame.limit(0), frame.limit(0)).isEmpty()


def test_packs_of_queries_do_not_grow_with_the_queries(spark, monkeypatch):
    visits = spark.range(40_000).selectExpr("0 AS curve", "int(id % 2) AS block", "id AS query", "CAST('equal' AS BINARY) AS bytes")
    sizes = [r.n for r in curves._packs(visits).select(F.size("queries").alias("n")).collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 2 * curves.PACK
    rng = np.random.default_rng(5)
    query, points = rng.normal(size=(30, 8)), rng.normal(size=(200, 8))
    best = lambda: [(i.tolist(), s.tolist()) for i, s in curves._best(query, np.arange(30), points, [np.array([i]) for i in range(200)], 5)]
    whole = best()
    monkeypatch.setattr(curves, "SLICE", 7)
    assert best() == whole
