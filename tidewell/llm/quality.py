"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text.

Symbols are characters: every code point is one of its own, so texts of any script are told apart, and the model grows
with the text it learns from. The model is of order 4. Counts of trusted text are summed per block and by gram; lower
orders count the different grams that end in a gram. Discounts, left-over weights and probabilities come from joins of the
count tables, sharded by gram or context, for all grams that occur in any document.

Documents are scored without a shuffle of all their grams: they are put into chunks of about ``CHUNK`` bytes, and a chunk
asks for each of its different grams once. The answers, joined by gram, meet the texts of their chunk and are summed per
document. A document stays if its perplexity lies between two quantiles of the trusted documents in its language, with a
margin: text that surprises too much is junk, text that surprises too little repeats.

Trusted documents are those that ``labels.quality`` marks 1, outside the fold held out for tests. All of them count: the
model learns from three quarters, and the quantiles come from the rest, which the model has not seen.

Chunks are written once in the shared folder: their numbers must not change when a lost task runs again. They lie in
buckets, so that their texts are not dealt again when the answers come.

Defined results: null and empty texts have no perplexity and are not kept; a null language is a language of its own; a
language without trusted documents takes the quantiles of all; without any trusted document nothing is kept; of repeated
labels the lower counts; equal rows are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from tidewell import session
from tidewell.llm.common import bucketed, release, released, slices
from tidewell.llm.suffix import compressed

ORDER = 4
# Quantiles of trusted documents between which a document is kept.
LOW, HIGH = 0.005, 0.995
# Factor by which a perplexity may lie beyond them: quantiles of few documents fall short of their range.
MARGIN = 1.2
# Characters turned into grams at a time.
BLOCK = 1_000_000
# Bytes of text in a chunk; one longer text is a chunk of its own.
CHUNK = 32_000_000


@dataclass(frozen=True)
class Symbols:
    """What a model counts: ``numbers`` of code points, from 1 on (0 is the place before a text), of so many ``bits``.

    ``size`` is how many there are; without it, as many as occur in the documents."""

    bits: int
    numbers: Callable[[np.ndarray], np.ndarray]
    size: int | None = None


# Classes of characters, for a model of Latin text with a bounded number of grams; 63 is all other characters.
_CLASSES = [string.ascii_lowercase, string.ascii_uppercase, " \t", "\n\r", string.digits, ".", ",", ";:", "!", "?", "'\"", "()[]{}<>-/"]


def _class_table() -> np.ndarray:
    """Class by code point, up to the end of the Latin blocks; what lies beyond is in the last entry."""
    table = np.full(0x250 + 1, 63, np.uint32)
    symbol = 1
    for group in _CLASSES:
        for ch in group:
            table[ord(ch)] = symbol
            symbol += len(group) == 26
        symbol += len(group) != 26
    accented = [c for c in range(0xC0, 0x250) if chr(c).isalpha()]
    table[[c for c in accented if chr(c).islower()]] = 62
    table[[c for c in accented if not chr(c).islower()]] = 63
    return table


_TABLE = _class_table()
CLASSES = Symbols(6, lambda points: _TABLE[np.minimum(points, len(_TABLE) - 1)], 64)
CHARACTERS = Symbols(21, lambda points: points + np.uint32(1))


def grams(texts: list[str | None], symbols: Symbols = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each character of the texts, and where each text's begin (one more entry: the end).

    A gram is a number, as long as ``ORDER`` symbols fit 64 bits; else Python's own integers are needed."""
    lengths = np.array([len(text or "") for text in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    made = [np.zeros(0, object if ORDER * symbols.bits > 64 else np.uint64)]
    for _, before, at in _blocks("".join(text or "" for text in texts), lengths, symbols):
        made.append((before.astype(made[0].dtype) << 2 * symbols.bits) | at.astype(made[0].dtype))
    return np.concatenate(made), offsets


def _blocks(text: str, lengths: np.ndarray, symbols: Symbols) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each block of the joined texts: where it begins, and for each of its characters the pair of symbols that ends
    two places before it and the pair that ends at it. No pair reaches into the text before."""
    starts = np.cumsum(lengths) - lengths
    place = np.full(len(text), ORDER - 1, np.uint8)
    for back in range(ORDER - 1):
        place[starts[lengths > back] + back] = back
    for begin in range(0, len(text), BLOCK):
        early = max(begin - ORDER + 1, 0)
        part = np.frombuffer(text[early : begin + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        at = symbols.numbers(part).astype(np.uint64)
        inside = place[early : begin + BLOCK]
        at[1:] |= np.where(inside[1:] >= 1, at[:-1], np.uint64(0)) << np.uint64(symbols.bits)
        before = np.zeros_like(at)
        before[2:] = np.where(inside[2:] >= 2, at[:-2], np.uint64(0))
        yield begin, before[begin - early :], at[begin - early :]


def _places(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where each value is found among different ones."""
    return pc.index_in(pa.array(values), pa.array(among)).to_numpy(zero_copy_only=False).astype(np.uint64)


def _summed(context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different grams, with their numbers summed."""
    order = np.lexsort((symbol, context))
    context, symbol = context[order], symbol[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(order), 1), bool), (np.diff(context) != 0) | (np.diff(symbol) != 0)]))
    return context[first], symbol[first], np.add.reduceat(n[order], first) if len(first) else n


def _counted(text: str, lengths: np.ndarray, symbols: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different grams of the joined texts as context and symbol, and how often each comes."""
    bits, found = np.uint64(symbols.bits), []
    mask = np.uint64((1 << symbols.bits) - 1)
    for _, before, at in _blocks(text, lengths, symbols):
        pairs = np.unique(np.concatenate([at, before[:2], np.zeros(1, np.uint64)]))
        keys, n = np.unique(_places(before, pairs) << np.uint64(32) | _places(at, pairs), return_counts=True)
        first, last = pairs[keys >> np.uint64(32)], pairs[keys & np.uint64(0xFFFFFFFF)]
        found.append(((first << bits | last >> bits).astype(np.int64), (last & mask).astype(np.int32), n))
    if len(found) == 1:
        return found[0]
    none = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))
    return _summed(*map(np.concatenate, zip(none, *found, strict=True)))


def _counts(texts: DataFrame, symbols: Symbols) -> DataFrame:
    """``context, symbol, n`` over all ``texts`` (``packed``, zstd, or ``text``), summed per slice and then by gram."""
    (column,) = texts.columns
    plain = column == "text"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column, CHUNK // 4 if plain else CHUNK // 12):
            values = piece.column(0).to_pylist()
            values = [x or "" for x in values] if plain else [zstandard.decompress(x).decode() for x in values]
            sums = _counted("".join(values), np.array([len(x) for x in values], np.int64), symbols)
            for at in range(0, len(sums[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in sums], names=["context", "symbol", "n"])

    return texts.mapInArrow(released(counted), "context long, symbol int, n long").groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def _gram_counts(texts: DataFrame) -> DataFrame:
    """``gram, n`` over all ``texts``: grams of classes as one number."""
    gram = F.shiftleft("context", CLASSES.bits).bitwiseOR(F.col("symbol")).cast("int")
    return _counts(texts, CLASSES).select(gram.alias("gram"), "n")


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of an order, from how many grams are counted 1, 2, 3 and 4 times."""
    n = counts.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in range(1, 5)]).head()
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    # Kept above a small value, so that every context leaves some weight to what it has not seen.
    return [max(0.1, min(float(i), i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]


def _log_probabilities(counts: DataFrame, asked: DataFrame, bits: int, size: int) -> DataFrame:
    """``context, symbol, logp`` for the grams ``asked`` (``context, symbol``), by the model of ``counts`` (``context, symbol, n``).

    Grams are kept once per order: each table feeds several joins, and none may read the texts again.
    """

    def shorter(order: int) -> Column:
        """The context of a gram of ``order`` symbols without its first one."""
        return F.col("context").bitwiseAND(F.lit((1 << bits * (order - 2)) - 1).cast("long"))

    levels = {ORDER: session.durable(counts)}
    for order in range(ORDER - 1, 0, -1):
        ends = levels[order + 1].select(shorter(order + 1).alias("context"), "symbol")
        levels[order] = session.durable(ends.groupBy("context", "symbol").agg(F.count("*").alias("n")))

    def level(order: int, keys: DataFrame) -> DataFrame:
        """``context, symbol, p`` of the keys at an order."""
        keys = session.durable(keys.select("context", "symbol"))
        known = levels[order]
        one, two, three = _discounts(known)
        discount = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(three)
        spare = F.sum(F.least(discount, F.col("n"))) / F.sum("n")
        contexts = known.groupBy("context").agg(F.sum("n").alias("_total"), spare.alias("_spare"))
        seen = known.select("context", "symbol", (F.col("n") - F.least(discount, F.col("n"))).alias("_left"))
        rows = keys.join(seen, ["context", "symbol"], "left").join(contexts, "context", "left")
        if order > 1:
            ends = keys.select(shorter(order).alias("context"), "symbol").distinct()
            below = level(order - 1, ends).select(F.col("context").alias("_below"), F.col("symbol").alias("_symbol"), F.col("p").alias("_p"))
            rows = rows.join(below, (shorter(order) == F.col("_below")) & (F.col("symbol") == F.col("_symbol")))
        else:
            rows = rows.withColumn("_p", F.lit(1 / size))
        own = F.coalesce(F.col("_left") / F.col("_total"), F.lit(0.0))
        return rows.select("context", "symbol", (own + F.coalesce("_spare", F.lit(1.0)) * F.col("_p")).alias("p"))

    return level(ORDER, asked).select("context", "symbol", F.log("p").alias("logp"))


def log_probabilities(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """``gram, logp`` for the grams of classes ``asked``, by the model of ``counts`` (``gram, n``)."""
    context, symbol = F.shiftright("gram", CLASSES.bits).cast("long").alias("context"), F.col("gram").bitwiseAND(CLASSES.size - 1).alias("symbol")
    made = _log_probabilities(counts.select(context, symbol, "n"), asked.select(context, symbol), CLASSES.bits, CLASSES.size)
    return made.select(F.shiftleft("context", CLASSES.bits).bitwiseOR(F.col("symbol")).cast("int").alias("gram"), "logp")


def trusted(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the trusted documents, and ``fit``: whether the model learns from it, or only the quantiles do."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    good = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out)
    good = good.groupBy("doc_id").agg(F.min("quality").alias("_quality")).where("_quality = 1")
    return good.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) > 0).alias("fit"))


def _chunks(docs: DataFrame, symbols: Symbols) -> DataFrame:
    """``chunk, rows, lengths, texts`` for each chunk of ``docs`` (``_row, text``), and ``chunk, context, symbol`` for its different grams."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        rows, texts, held, schema = [], [], 0, None

        def emitted() -> Iterator[pa.RecordBatch]:
            chunk, whole = next(numbers), "".join(texts)
            lengths = np.array([len(text) for text in texts], np.int64)
            texts.clear()
            packed = zstandard.compress(whole.encode("utf-8", "surrogatepass"), 9)
            lists = pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.concat_arrays(rows))
            sizes = pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.array(lengths, pa.int32()))
            rows.clear()
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), lists, sizes, pa.array([packed], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32())], schema=schema)
            context, symbol, _ = _counted(whole, lengths, symbols)
            for at in range(0, len(context), 100_000):
                part = slice(at, at + 100_000)
                none, size = [pa.nulls(len(context[part]), kind) for kind in schema.types[1:4]], len(context[part])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, chunk)), *none, pa.array(context[part]), pa.array(symbol[part])], schema=schema)

        for piece in slices(batches, "text", CHUNK // 16):
            schema = schema or pa.schema(
                {"chunk": pa.int64(), "rows": pa.list_(piece.column("_row").type), "lengths": pa.list_(pa.int32()), "texts": pa.binary(), "context": pa.int64(), "symbol": pa.int32()}
            )
            # A copy: a column that was received keeps the whole batch, with its texts, in memory.
            rows.append(piece.column("_row").take(pa.array(range(piece.num_rows))))
            texts += [text or "" for text in piece.column("text").to_pylist()]
            held += pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0
            if held >= CHUNK:
                yield from emitted()
                held = 0
        if rows:
            yield from emitted()

    schema = StructType(
        [
            StructField("chunk", LongType()),
            StructField("rows", ArrayType(docs.schema["_row"].dataType)),
            StructField("lengths", ArrayType(IntegerType())),
            StructField("texts", BinaryType()),
            StructField("context", LongType()),
            StructField("symbol", IntegerType()),
        ]
    )
    return docs.mapInArrow(released(cut), schema)


def _assembled(chunk: pa.Table, answers: pa.Table, symbols: Symbols) -> pa.Table:
    """``_row, n_symbols, perplexity`` of a chunk's documents, from the answers to its grams."""
    bits, mask = np.uint64(symbols.bits), np.uint64((1 << symbols.bits) - 1)
    context, symbol = (answers.column(c).to_numpy().astype(np.uint64) for c in ("context", "symbol"))
    logp = answers.column("logp").to_numpy().astype(np.float64)
    first, last = context >> bits, (context & mask) << bits | symbol
    pairs = np.unique(np.concatenate([first, last]))
    keys = _places(first, pairs) << np.uint64(32) | _places(last, pairs)
    rows = chunk.column("rows").combine_chunks().flatten()
    lengths = chunk.column("lengths").combine_chunks().flatten().to_numpy().astype(np.int64)
    whole = zstandard.decompress(chunk.column("texts")[0].as_py()).decode("utf-8", "surrogatepass")
    ends, sums = np.cumsum(lengths), np.zeros(len(lengths))
    for begin, before, at in _blocks(whole, lengths, symbols):
        found = logp[_places(_places(before, pairs) << np.uint64(32) | _places(at, pairs), keys)]
        behind = np.concatenate([[0.0], np.cumsum(found)])
        some = slice(int(np.searchsorted(ends, begin, "right")), int(np.searchsorted(ends - lengths, begin + len(at), "left")))
        stop = np.minimum(ends[some] - begin, len(at))
        sums[some] += behind[stop] - behind[np.maximum(ends[some] - lengths[some] - begin, 0)]
    perplexity = np.exp(-sums / np.maximum(lengths, 1))
    return pa.table([rows, pa.array(lengths), pa.array(perplexity, mask=lengths == 0)], names=["_row", "n_symbols", "perplexity"])


def scored(docs: DataFrame, labels: DataFrame, symbols: Symbols = CLASSES) -> DataFrame:
    """``docs`` (``doc_id, text, lang``) without the text, with ``n_symbols`` and ``perplexity``."""
    # Labels grow with the documents, so they are never broadcast, however few they are.
    wanted = trusted(labels).where("fit").select("doc_id").hint("shuffle_hash")
    good = docs.select("doc_id", compressed(F.col("text")).alias("packed")).join(wanted, "doc_id").select("packed")
    chunks = bucketed(_chunks(docs.select(F.struct("doc_id", "lang").alias("_row"), "text"), symbols), "quality-chunks", "chunk")
    wants = chunks.where("context IS NOT NULL").select("chunk", "context", "symbol")
    asked = wants.select("context", "symbol").distinct()
    size = symbols.size or max(wants.select("symbol").distinct().count(), 1)
    table = _log_probabilities(_counts(good, symbols), asked, symbols.bits, size)
    wants = wants.withColumnRenamed("chunk", "asker")
    answers = wants.join(table.select("context", "symbol", F.col("logp").cast("float").alias("logp")), ["context", "symbol"])
    texts = chunks.where("texts IS NOT NULL").select("chunk", "rows", "lengths", "texts")

    def assemble(chunk: pa.Table, given: pa.Table) -> pa.Table:
        release()
        return _assembled(chunk, given, symbols)

    fields = [StructField("_row", chunks.schema["rows"].dataType.elementType), StructField("n_symbols", LongType()), StructField("perplexity", DoubleType())]
    whole = texts.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(assemble, StructType(fields))
    return whole.select("_row.doc_id", "_row.lang", "n_symbols", "perplexity")


def judged(docs: DataFrame, labels: DataFrame, symbols: Symbols = CLASSES) -> DataFrame:
    """``doc_id, lang, n_symbols, perplexity, low, high, kept``."""
    rows = session.stored(scored(docs, labels, symbols), "quality-scores")
    good = rows.join(trusted(labels).where("NOT fit"), "doc_id")
    quantiles = F.percentile_approx("perplexity", F.array(F.lit(LOW), F.lit(HIGH)), 10_000)
    by_language = good.groupBy(F.col("lang").alias("_lang")).agg(quantiles.alias("_own"))
    every = good.agg(quantiles.alias("_all")).head()[0] or [None, None]
    bound = lambda i: F.coalesce(F.get("_own", F.lit(i)), F.lit(every[i]).cast("double")) * MARGIN ** (2 * i - 1)
    met = rows.join(by_language, F.col("lang").eqNullSafe(F.col("_lang")), "left").select("*", bound(0).alias("low"), bound(1).alias("high"))
    kept = F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return met.select("doc_id", "lang", "n_symbols", "perplexity", "low", "high", kept.alias("kept"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    return judged(docs, spark.read.parquet(f"{folder}/labels.parquet"), CHARACTERS)
