"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are all strings of 2 to 4 bytes of the lower-cased letters of a text, hashed to 2**16 buckets. A text is the
mean of its subwords' embeddings, classified by a linear softmax. Embeddings and classifier are trained together by
stochastic gradient descent in numpy on a bounded sample of every language: about ``PER_LANGUAGE`` texts, whole, and
no more than its part of ``SAMPLE_BYTES``. The sample has fewer texts of frequent languages than the corpus has, so the
counted shares of the languages are put back into the classifier's bias. A fifth of the sample, weighted likewise, sets
the temperature of the scores and the least score at which predictions are right often enough to be accepted.

Defined results: null texts and texts without a letter are ``und`` with score 0 and not accepted; equal texts get equal
results; without labelled texts everything is ``und``; an empty table gives an empty table; columns may have any names
but those of the results.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import slices

# The bounds of the sample: texts of a language, and bytes of all texts' subwords, as many as they can be at most.
PER_LANGUAGE = 600
SAMPLE_BYTES = 256 << 20
BUCKET_BITS = 16
DIMENSIONS = 16
ORDERS = (2, 3, 4)
EPOCHS = 6
RATE = 2.0
# Share of right predictions among the accepted ones.
PRECISION = 0.99
UNKNOWN = "und"
# Bytes of text hashed at a time.
BLOCK = 400_000

_SPACES = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))
_PAD = b" " * max(ORDERS)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learned from; null ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _letters(text: str | None) -> bytes:
    """The lower-cased words of a text between single blanks; empty if there is no letter."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return b" " + b" ".join(text.lower().encode().translate(_SPACES).split()) + b" "


def _codes(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the bucket at every byte of the joined texts, and where texts and gaps begin, alternating."""
    joined = np.frombuffer(b"".join(part for text in texts for part in (text, _PAD)), np.uint8)
    word = np.ndarray((len(joined) - 3,), "<u4", joined, strides=(1,)) if len(joined) >= 4 else np.zeros(0, np.uint32)
    lengths = np.array([n for text in texts for n in (len(text), len(_PAD))])
    made = []
    for order in ORDERS:
        part = word & np.uint32((1 << 8 * order) - 1)
        made.append(((part ^ np.uint32(order * 0x3779B97F)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS))
    return made, np.cumsum(lengths) - lengths


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    codes, _ = _codes([text])
    buckets, counts = np.unique(np.concatenate([c[: len(text)] for c in codes]), return_counts=True)
    return buckets, (counts / counts.sum()).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    classifier: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """One row per text; what comes first, classifying buckets or averaging them, depends on which is narrower."""
        narrow = len(self.languages) <= DIMENSIONS
        table = self.embeddings @ self.classifier if narrow else self.embeddings
        codes, bounds = _codes(texts)
        sums = np.zeros((len(texts), table.shape[1]), np.float32)
        for code in codes:
            sums += np.add.reduceat(np.append(table[code], np.zeros((4, table.shape[1]), np.float32), axis=0), bounds, axis=0)[::2]
        sizes = np.array([[max(len(text), 1) * len(ORDERS)] for text in texts])
        means = np.where(np.array([[len(text) > 0] for text in texts]), sums / sizes, 0)
        return (means if narrow else means @ self.classifier) + self.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(examples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7, counts: Mapping[str, int] | None = None) -> Model | None:
    """The model of ``(language, buckets, shares)``; every fifth example of a language calibrates.

    ``counts`` are the texts of each language in the corpus: what the examples have too few or too many of is set right.
    """
    languages = sorted({language for language, _, _ in examples})
    if not languages:
        return None
    index = {language: i for i, language in enumerate(languages)}
    rng = np.random.default_rng(seed)
    embeddings = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    classifier = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    seen: dict[str, int] = {}
    fit, check = [], []
    for example in examples:
        seen[example[0]] = seen.get(example[0], 0) + 1
        (check if seen[example[0]] % 5 == 0 else fit).append(example)
    steps, total = 0, EPOCHS * len(fit)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            language, buckets, shares = fit[i]
            rate, steps = np.float32(RATE * (1 - steps / total)), steps + 1
            hidden = shares @ embeddings[buckets]
            error = _softmax(hidden @ classifier + bias)
            error[index[language]] -= 1
            back = classifier @ error
            classifier -= rate * np.outer(hidden, error)
            bias -= np.float32(0.1) * rate * error
            # Shares are small, so embeddings move in proportion to how often a bucket occurs.
            embeddings[buckets] -= rate * np.outer(shares * np.float32(np.sqrt(len(shares))), back)
    weight = {language: (counts or seen).get(language, n) / n for language, n in seen.items()}
    bias += np.log([weight[language] for language in languages], dtype=np.float32)
    bias -= bias.mean()
    model = Model(languages, embeddings, classifier, bias, 1.0, 0.0)
    if check:
        logits = np.array([shares @ embeddings[buckets] @ classifier + bias for _, buckets, shares in check])
        truth = np.array([index[language] for language, _, _ in check])
        weights = np.array([weight[language] for language, _, _ in check])
        loss = lambda t: -(weights * np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12)).sum()
        model.temperature = float(min(np.geomspace(0.5, 10, 61), key=loss))
        scores = _softmax(logits / model.temperature)
        right, best = scores.argmax(axis=1) == truth, scores.max(axis=1)
        order = np.argsort(-best)
        precise = np.flatnonzero(np.cumsum((weights * right)[order]) >= PRECISION * np.cumsum(weights[order]))
        model.least = float(best[order][precise[-1]]) if len(precise) else 1.0
        if len(precise) and precise[-1] == len(order) - 1:  # right often enough even at the lowest scores seen
            model.least = min(model.least, 0.5)
    return model


def label_counts(docs: DataFrame) -> dict[str, tuple[int, int]]:
    """Texts and bytes of every language that may be learned: one row per language."""
    rows = _learnable(docs).groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()
    return {r["lang"]: (r["n"], r["size"]) for r in rows}


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def examples(docs: DataFrame, counts: Mapping[str, tuple[int, int]] | None = None) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """The bounded sample, as buckets and shares: at most 2**16 of each per text. ``counts`` are the :func:`label_counts`."""
    counts = label_counts(docs) if counts is None else counts
    if not counts:
        return []
    # A byte of text gives at most a subword of every order, of eight bytes each. What languages of little text leave
    # of their part goes to the others.
    wanted = {lang: size * min(1.0, PER_LANGUAGE / n) for lang, (n, size) in counts.items()}
    left, rows = SAMPLE_BYTES / (8 * len(ORDERS)), []
    for i, lang in enumerate(sorted(counts, key=lambda x: (wanted[x], x))):
        taken = min(wanted[lang], left / (len(counts) - i))
        left -= taken
        rows.append((lang, taken / max(counts[lang][1], 1) if counts[lang][1] else 1.0))
    shares_of = docs.sparkSession.createDataFrame(rows, "lang string, _share double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    # One row per language.
    met = _learnable(docs).select("doc_id", "lang", "text").join(F.broadcast(shares_of), "lang")
    sampled = met.where(place < F.col("_share")).select("doc_id", "lang", "text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
                if letters := _letters(text):
                    buckets, shares = bag(letters)
                    rows.append((doc, lang, buckets.astype("<u4").tobytes(), shares.astype("<f4").tobytes()))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "lang", "buckets", "shares"])

    rows = sampled.mapInArrow(made, "doc_id long, lang string, buckets binary, shares binary").collect()
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.lang, bytes(r.buckets), bytes(r.shares)))
    return [(r.lang, np.frombuffer(r.buckets, "<u4"), np.frombuffer(r.shares, "<f4")) for r in rows]


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "accepted": F.lit(False)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double, accepted boolean>")
    def found(texts: pa.Array) -> pa.Array:
        model = shared.value
        langs, scores = [], []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for piece in slices(iter([batch]), "text", BLOCK):
            letters = [_letters(x) for x in piece.column("text").to_pylist()]
            probabilities = _softmax(model.logits(letters).astype(np.float64) / model.temperature)
            best = probabilities.argmax(axis=1)
            langs += [model.languages[b] if x else UNKNOWN for b, x in zip(best.tolist(), letters, strict=True)]
            scores += [float(p) if x else 0.0 for p, x in zip(probabilities.max(axis=1), letters, strict=True)]
        accepted = [lang != UNKNOWN and score >= model.least for lang, score in zip(langs, scores, strict=True)]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())], names=["lang_pred", "score", "accepted"])

    predicted = docs.withColumn("_found", found(F.col(text)))
    return predicted.withColumns({c: F.col(f"_found.{c}") for c in ("lang_pred", "score", "accepted")}).drop("_found")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    counts = label_counts(docs)
    model = train(examples(docs, counts), counts={lang: n for lang, (n, _) in counts.items()})
    predicted = predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
