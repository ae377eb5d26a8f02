"""Toxicity from a weighted lexicon, matched by Aho-Corasick after folding, normalised by length.

Texts are folded first: case, accents, look-alike letters of other scripts, digits and signs that stand for letters.
The lexicon holds beginnings of words (and whole words) with the log odds of their rates in toxic and clean texts;
at each word the longest entry counts. Exception phrases, one or two words that hold an entry but are no more frequent
in toxic texts, cancel the matches inside them. Sums of weights, per word and per root of words, go through a logistic
function fitted on documents that the lexicon has not seen.

Lexicon and function are learned from a bounded sample: at most ``SAMPLE`` labelled documents of each label, chosen by
a hash of their id, with whole texts. Labels of all learnable documents are counted, and each sampled document weighs
as many of its label as it stands for, so that scores mean the same at every size. Everything else covers all documents.

Defined results: null and empty texts have no match and get the score of such texts; labels that are null or neither 0
nor 1 teach nothing, of repeated labels the higher counts; without labels of both kinds every score is 0; equal rows
are scored alike; an empty table gives an empty table; columns may have any names but those of the results.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import session
from tidewell.llm.common import release, released

# Documents of each label in the sample that lexicon and function are learned from.
SAMPLE = 4_000
# Most entries of the lexicon, and most exception phrases.
ENTRIES = 5_000
THRESHOLD = 0.3
# Phrases that a task holds before it hands on their counts.
HELD = 200_000
PREFIXES = range(4, 11)
# Standard errors by which the odds of an entry must differ from even.
LEAST_Z = 3.5

# Letters of other scripts that look like Latin ones, and what digits and signs stand for.
LOOKALIKES = dict(zip("абвгдезікмнопрстухуьАВЕКМНОРСТХУІЈѕјԁһԛԝɡαβεικνορτυχωΑΒΕΖΗΙΚΜΝΟΡΤΥΧıłøđ", "abbrde3ikmhonpctyxybABEKMHOPCTXYIJsjdhqwgabeikvoptuxwABEZHIKMNOPTYXilod", strict=True))
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_ASCII = {c: chr(c) if chr(c).isalpha() else STANDS_FOR.get(chr(c), " ") for c in range(128)}
_BANG = re.compile(r"!(?=[a-zA-Z])")


def fold(text: str | None) -> str:
    """The text as folded words with one blank before and behind each."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        for ch in set(text):
            if ord(ch) > 127:
                text = text.replace(ch, "" if unicodedata.combining(ch) else LOOKALIKES.get(ch, ch if ch.isalpha() else " "))
    if "!" in text:
        text = _BANG.sub("i", text)
    return f" {' '.join(text.lower().translate(_ASCII).split())} "


@dataclass
class Model:
    """Entries with weights (a blank before them, one behind whole words), exception phrases, and the function."""

    entries: dict[str, float]
    exceptions: list[str]
    weights: list[float] | None

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            found.add_word(entry, (len(entry), weight, False))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), self.entries.get(phrase, 0.0), True))
        if not len(found):
            return None
        found.make_automaton()
        return found


def features(folded: str, automaton: ahocorasick.Automaton | None) -> list[float]:
    """Sum of weights per 100 words, per root of words, its logarithm, and the logarithm of the words."""
    words, longest, excused = folded.count(" ") - 1, {}, []
    for end, (length, weight, exception) in automaton.iter(folded) if automaton else ():
        if exception:
            excused.append((end - length + 1, end))
        else:
            longest[end - length + 1] = weight
    for start, end in excused:
        for at in [at for at in longest if start <= at < end]:
            del longest[at]
    total = max(0.0, sum(longest.values()))
    return [100 * total / (words + 10), total / np.sqrt(words + 10), np.log1p(total), np.log1p(max(words, 0))]


def _phrases(folded: str) -> Iterator[str]:
    words = folded.split()
    for word in words:
        yield f" {word} "
        for n in PREFIXES:
            if n <= len(word):
                yield f" {word[:n]}"
    for first, second in zip(words, words[1:], strict=False):
        yield f" {first} {second} "


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of every candidate in toxic and clean texts of each half, and documents that hold it, for the task."""
    sums, docs = defaultdict(Counter), defaultdict(Counter)

    def counts() -> Iterator[pa.RecordBatch]:
        for half in (0, 1):
            names = list(sums[half, 1].keys() | sums[half, 0].keys())
            columns = [pa.array([c[half, toxic][x] for x in names], pa.int64()) for c in (sums, docs) for toxic in (1, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([half] * len(names), pa.int64()), *columns],
                names=["phrase", "half", "toxic", "clean", "toxic_docs", "clean_docs"],
            )
        sums.clear()
        docs.clear()

    for batch in batches:
        for text, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half")), strict=True):
            own = Counter(_phrases(fold(text)))
            own[""] = sum(n for phrase, n in own.items() if phrase.endswith(" ") and phrase.count(" ") == 2)
            sums[half, toxic].update(own)
            docs[half, toxic].update(own.keys())
            if sum(map(len, sums.values())) > HELD:
                yield from counts()
    yield from counts()


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, half, weight`` of the sampled documents outside the held-out fold.

    ``weight`` is how many learnable documents of its label a sampled one stands for.
    """
    known = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    # Each task keeps SAMPLE ids of a label at most, and only these meet.
    in_order = [F.xxhash64("doc_id"), F.col("doc_id")]
    number = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    clean, toxic = (
        known.where(F.col("toxic") == value).orderBy(*in_order).limit(SAMPLE).withColumn("weight", F.lit(max(1.0, number.get(value, 0) / SAMPLE)))
        for value in (0, 1)
    )
    chosen = clean.union(toxic)
    half = F.pmod(F.crc32(F.concat(F.lit("half "), F.col("doc_id").cast("string"))), F.lit(2))
    # The sample has at most 2 * SAMPLE ids, so it may be broadcast at any size of the tables.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", half.alias("half"), "weight")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learned from; null ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression over weighted rows, intercept last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


_COUNTS = ("toxic", "clean", "toxic_docs", "clean_docs")


def _lexicon(counts: DataFrame) -> Model:
    """Entries and exception phrases from the counts of the phrases."""
    counts = counts.groupBy("phrase").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    every = counts.where("phrase = ''").agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("toxic", "clean")]).head()
    odds = F.log((F.col("toxic") + 0.5) / (every.toxic + 1)) - F.log((F.col("clean") + 0.5) / (every.clean + 1))
    z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    weighed = counts.where("phrase <> ''").select("phrase", "toxic_docs", "clean_docs", odds.alias("odds"), z.alias("z"))
    two_words = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) == 3
    chosen = weighed.where(~two_words & (F.col("z") >= LEAST_Z) & (F.col("odds") >= 1) & (F.col("toxic_docs") >= 3))
    entries = {r.phrase: float(r.odds) for r in chosen.orderBy(F.desc("z"), "phrase").limit(ENTRIES).collect()}
    # Whole words and pairs of words whose first word holds an entry, no more frequent in toxic texts.
    starts = F.array(*[F.substring("phrase", 1, n + 1) for n in PREFIXES])
    innocent = weighed.where("phrase LIKE '% ' AND odds <= 0 AND clean_docs >= 3")
    innocent = innocent.where(F.arrays_overlap(starts, F.lit(list(entries)))) if entries else innocent.limit(0)
    return Model(entries, [r.phrase for r in innocent.orderBy("z", "phrase").limit(ENTRIES).collect()], None)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The lexicon of the whole sample, with a function fitted on each half by the lexicon of the other."""
    rows = sample(docs, labels)
    schema = "phrase string, half long, toxic long, clean long, toxic_docs long, clean_docs long"
    counts = rows.mapInArrow(released(_counted), schema).groupBy("phrase", "half").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    counts = session.durable(counts.where("phrase = '' OR toxic_docs + clean_docs >= 2"))
    model = _lexicon(counts)
    seen = []
    for half in (0, 1):
        other = _lexicon(counts.where(F.col("half") != half))
        own = rows.where(F.col("half") == half)
        seen += own.select(_features(F.col("text"), other, rows.sparkSession).alias("x"), "toxic", "weight").collect()
    y = np.array([r.toxic for r in seen], float)
    if 0 < y.sum() < len(y):
        model.weights = _logistic(np.array([r.x for r in seen]), y, np.array([r.weight for r in seen])).tolist()
    return model


def _features(text: Column, model: Model, spark: SparkSession) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def made(texts: pa.Array) -> pa.Array:
        automaton = shared.value.automaton()
        found = pa.array([features(fold(text.as_py()), automaton) for text in texts], pa.list_(pa.float64()))
        release()
        return found

    return made(text)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more likely toxic) and ``predicted`` (1 from ``THRESHOLD`` on)."""
    if model.weights is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    *weights, intercept = model.weights
    x = docs.withColumn("_x", _features(F.col(text), model, docs.sparkSession))
    line = sum((F.get("_x", F.lit(i)) * w for i, w in enumerate(weights)), F.lit(intercept))
    scored = x.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(line, F.lit(500.0)), F.lit(-500.0)))))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).drop("_x")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
