"""Byte-level BPE over a global shuffle of distinct words, and decoding by a join with the token-byte table.

1. Pre-tokens of the texts are numbered with their positions, in chunks of about ``CHUNK`` bytes of text. A chunk
   keeps the sequence of its word numbers and lists every distinct word once, dealt to shards by hash.
2. A shard sees each of its words from all chunks, encodes it once and answers every chunk with the ids. A frequent
   word comes at most once from each chunk, so there are no hot words.
3. Answers meet the sequence of their chunk, and ids are put together by position.
4. Decoding joins the ids with the token-byte table on the map side; the vocabulary bounds the table.

Chunks are written once in the shared folder: their numbers must not change when a lost task runs again.

Defined results: a null text is encoded like an empty one, to no ids; ids outside the vocabulary decode to nothing;
equal rows are encoded each; an empty table gives an empty table; columns may have any names but that of the result.
"""

from __future__ import annotations

import base64
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tidewell.llm.common import release, released, shuffle_partitions, slices, written

# Bytes of text in a chunk: what a task holds at a time; one longer text is a chunk of its own.
CHUNK = 16_000_000
# Words put together at a time.
BLOCK = 250_000


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file; the vocabulary bounds them."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _pack(*arrays: np.ndarray, tail: bytes = b"", level: int = 9) -> bytes:
    """Arrays of small numbers, byte planes apart so that the empty ones vanish, and raw bytes behind them."""
    parts = [np.array([len(arrays), *map(len, arrays)], "<u4").tobytes()]
    parts += [a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join([*parts, tail]), level)


def _pack_ranked(blocks: Iterable[np.ndarray]) -> bytes:
    """Small numbers that are mostly below 255 in one byte each, the others in full behind them; given block by block."""
    rare, common = [], []
    for numbers in blocks:
        rare.append(numbers[numbers >= 255] - 255)
        common.append(np.minimum(numbers, 255).astype(np.uint8))
    return _pack(np.concatenate(rare), tail=np.concatenate(common).tobytes())


def _unpack_ranked(packed: bytes, ends: Iterable[int]) -> Iterator[np.ndarray]:
    """The numbers again, from one of ``ends`` to the next: only one such block is held in full."""
    (rare,), common = _unpack(packed)
    start = used = 0
    for end in ends:
        numbers = np.frombuffer(common, np.uint8, end - start, start).astype(np.uint32)
        high = np.flatnonzero(numbers == 255)
        numbers[high] += rare[used : used + len(high)]
        start, used = end, used + len(high)
        yield numbers


def _unpack(packed: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.decompress(packed)
    count = int(np.frombuffer(raw, "<u4", 1)[0])
    at, arrays = 4 + 4 * count, []
    for n in np.frombuffer(raw, "<u4", count, 4).tolist():
        planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
        arrays.append(np.ascontiguousarray(planes.T).view("<u4").reshape(n))
        at += 4 * n
    return arrays, raw[at:]


class _Chunk:
    """Texts on their way to a chunk: numbers of words by position, and the words."""

    def __init__(self, pattern: regex.Pattern):
        self.split = pattern.findall
        self.numbers: dict[str, int] = defaultdict(itertools.count().__next__)
        self.rows, self.sizes, self.sequences, self.held = [], [], [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        # A copy: a column that was received keeps the whole batch, with its texts, in memory.
        self.rows.append(batch.column("_row").take(pa.array(range(batch.num_rows))))
        found = []
        for text in batch.column("_text").to_pylist():
            words = self.split(text) if text else []
            found.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.sizes += map(len, found)
        self.sequences.append(np.concatenate(found))
        self.held += pc.sum(pc.binary_length(batch.column("_text"))).as_py() or 0

    def emit(self, chunk: int, shards: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The sequence row, then one row of words for each shard that has any. Frequent words get small numbers."""
        rows = pa.concat_arrays(self.rows)
        order = np.argsort(-sum(np.bincount(block, minlength=len(self.numbers)) for block in self.sequences), kind="stable")
        renumbered = np.empty(len(order), np.uint32)
        renumbered[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.numbers)
        self.numbers.clear()
        coded = [words[i].encode() for i in order.tolist()]
        del words
        shard = np.fromiter((zlib.crc32(word) % shards for word in coded), np.int64, len(coded))
        ranked = _pack_ranked(renumbered[block] for block in self.sequences)
        self.sequences.clear()
        packed = _pack(np.array(self.sizes), shard, tail=ranked)
        lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk]), lists, pa.array([packed], pa.binary()), pa.array([None], pa.int32()), pa.array([None], pa.binary())],
            schema=schema,
        )
        for number in np.unique(shard).tolist():
            mine = [coded[i] for i in np.flatnonzero(shard == number)]
            words = _pack(np.array([len(word) for word in mine]), tail=b"".join(mine))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.nulls(1, lists.type), pa.array([None], pa.binary()), pa.array([number], pa.int32()), pa.array([words], pa.binary())],
                schema=schema,
            )


def _chunks(docs: DataFrame, pattern: str, shards: int) -> DataFrame:
    """``chunk, rows, sequence`` for each chunk and ``chunk, shard, words`` for its words."""
    row = docs.schema["_row"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        compiled = regex.compile(pattern)
        chunk, schema = _Chunk(compiled), None
        for piece in slices(batches, "_text", CHUNK // 8):
            schema = schema or pa.schema(
                {"chunk": pa.int64(), "rows": pa.list_(piece.column("_row").type), "sequence": pa.binary(), "shard": pa.int32(), "words": pa.binary()}
            )
            chunk.add(piece)
            if chunk.held >= CHUNK:
                yield from chunk.emit(next(numbers), shards, schema)
                chunk = _Chunk(compiled)
        if chunk.rows:
            yield from chunk.emit(next(numbers), shards, schema)

    schema = StructType(
        [
            StructField("chunk", LongType()),
            StructField("rows", ArrayType(row)),
            StructField("sequence", BinaryType()),
            StructField("shard", IntegerType()),
            StructField("words", BinaryType()),
        ]
    )
    return docs.mapInArrow(released(cut), schema)


def _answers(words: DataFrame, ranks, pattern: str) -> DataFrame:
    """``chunk, shard, coded``: the ids of a chunk's words of one shard, each distinct word encoded once in its shard."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        at, known = None, {}
        for batch in batches:
            coded = []
            for shard, packed in zip(batch.column("shard").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if shard != at:
                    at, known = shard, {}
                (lengths,), joined = _unpack(packed)
                ends = np.cumsum(lengths).tolist()
                ids = []
                for start, end in zip([0, *ends[:-1]], ends, strict=True):
                    word = joined[start:end]
                    found = known.get(word)
                    if found is None:
                        found = known[word] = encoding.encode_ordinary(word.decode())
                    ids.append(found)
                coded.append(_pack(np.array([len(x) for x in ids]), np.array(list(itertools.chain.from_iterable(ids)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("shard"), pa.array(coded, pa.binary())], names=["chunk", "shard", "coded"]
            )

    shards = shuffle_partitions(words.sparkSession)
    return words.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(released(encode), "chunk long, shard int, coded binary")


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + length]`` one behind the other."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _assembled(chunk: pa.Table, answers: pa.Table, packed: bool, table: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> pa.Table:
    """The rows of a chunk with their ids, in batches of texts that end within the same ``BLOCK`` of words."""
    (counts, shard), ranked = _unpack(chunk.column("sequence")[0].as_py())
    by_shard = dict(zip(answers.column("shard").to_pylist(), answers.column("coded").to_pylist(), strict=True))
    parts = [_unpack(by_shard[s])[0] for s in sorted(by_shard)]
    in_order, flat = [np.concatenate([np.zeros(0, np.uint32), *arrays]).astype(np.int32) for arrays in (zip(*parts, strict=True) if parts else ([], []))]
    del by_shard, parts
    lengths, starts = np.zeros(len(shard), np.int32), np.zeros(len(shard), np.int32)
    order = np.argsort(shard, kind="stable")
    lengths[order], starts[order] = in_order, np.cumsum(in_order) - in_order
    rows = chunk.column("rows").combine_chunks()
    rows = rows.values.slice(rows.offsets[0].as_py(), len(counts))
    ends = np.cumsum(counts, dtype=np.int64)
    cuts = [*(np.flatnonzero(np.diff(ends // BLOCK)) + 1).tolist(), len(counts)]
    batches, first = [], 0
    for last, words in zip(cuts, _unpack_ranked(ranked, [int(ends[cut - 1]) for cut in cuts]), strict=True):
        blocks = (words[at : at + BLOCK] for at in range(0, len(words), BLOCK))
        ids = np.concatenate([np.zeros(0, np.int32), *(_gather(flat, starts[block], lengths[block]) for block in blocks)])
        behind = np.cumsum(np.concatenate([np.zeros(1, np.int32), lengths[words]]), dtype=np.int32)
        offsets = behind[np.concatenate([[0], np.cumsum(counts[first:last], dtype=np.int64)])]
        made = {"_row": rows.slice(first, last - first)}
        spans = list(itertools.pairwise(offsets.tolist()))
        if packed:
            made["ids"] = pa.array([ids[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary())
        else:
            made["ids"] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
        if table:
            made["decoded"] = pa.array([_bytes_of(ids[a:b], table) for a, b in spans], pa.binary())
        batches.append(pa.RecordBatch.from_arrays(list(made.values()), names=list(made)))
        first = last
    return pa.Table.from_batches(batches)


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    keep: list[str] | None = None,
    out: str = "ids",
    packed: bool = False,
    decoded: str | None = None,
) -> DataFrame:
    """The columns ``keep`` (all, if not given) with the ids of ``text`` as an array of ints.

    ``packed`` gives the ids as little-endian unsigned 32-bit numbers instead; ``decoded`` names a further column with
    the bytes that the ids stand for, joined in the task that has put the ids together.
    """
    spark = docs.sparkSession
    slim = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("_row"), docs[text].alias("_text"))
    chunks = written(_chunks(slim, pattern, shuffle_partitions(spark)), "bpe-chunks")
    answers = _answers(chunks.where("shard IS NOT NULL").select("chunk", "shard", "words"), spark.sparkContext.broadcast(ranks), pattern)
    sequences = chunks.where("shard IS NULL").select("chunk", "rows", "sequence")
    fields = [slim.schema["_row"], StructField("ids", BinaryType() if packed else ArrayType(IntegerType()))]
    table = spark.sparkContext.broadcast(token_table(ranks)) if decoded else None
    if decoded:
        fields.append(StructField("decoded", BinaryType()))

    def assemble(chunk: pa.Table, words: pa.Table) -> pa.Table:
        release()
        return _assembled(chunk, words, packed, table.value if table else None)

    whole = sequences.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(assemble, StructType(fields))
    return whole.select("_row.*", F.col("ids").alias(out), *([F.col("decoded").alias(decoded)] if decoded else []))


def _bytes_of(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    """The bytes of the ids, from the token-byte table; the last place of the table stands for unknown ids."""
    flat, starts, lengths = table
    known = np.where((ids < 0) | (ids >= len(lengths)), len(lengths) - 1, ids)
    blocks = (known[at : at + BLOCK] for at in range(0, len(known), BLOCK))
    return b"".join(_gather(flat, starts[block], lengths[block]).tobytes() for block in blocks)


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and start and length by id; ids that are free have length 0."""
    size = max(ranks.values(), default=-1) + 1
    lengths = np.zeros(size + 1, np.int64)
    in_order = sorted(ranks, key=ranks.__getitem__)
    lengths[[ranks[token] for token in in_order]] = [len(token) for token in in_order]
    return np.frombuffer(b"".join(in_order), np.uint8), np.cumsum(lengths) - lengths, lengths


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for: a map-side join with the token-byte table."""
    table = encoded.sparkSession.sparkContext.broadcast(token_table(ranks))

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        rows = (np.asarray(row.values if row.is_valid else [], np.int64) for row in lists)
        return pa.array([_bytes_of(row, table.value) for row in rows], pa.binary())

    return encoded.withColumn(out, joined(F.col(ids)))


def coded_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    ranks = read_ranks(docs.sparkSession, path)
    coded = encode(docs, ranks, pattern, keep=["doc_id"], packed=True, decoded="decoded")
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return coded_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
