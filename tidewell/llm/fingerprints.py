"""Document fingerprints: one-permutation MinHash, optimal densification, packed low-order bits.

A shingle is hashed once: its first bits choose one of 512 bins, the rest compete for the bin's minimum. Empty bins are
filled from filled ones, and two bits of each bin are kept, 128 bytes a text. Of two unrelated texts a quarter of
the bins agree by chance; the likeness takes that out, so it estimates the Jaccard similarity of the sets of five-word
shingles (standard error 0.03 at most).

Defined results: null, empty and blank texts have the empty fingerprint, whose likeness is 1 to itself and 0 to any
other; equal texts have equal fingerprints; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import written
from tidewell.llm.shingles import EMPTY, bin_minima, densified, mixed, shingle_hashes

WORDS = 5
BIN_BITS = 9
LOW_BITS = 2
# Bytes of text hashed at a time.
BLOCK = 1_000_000


def sketch(texts: Sequence[bytes | None]) -> list[bytes]:
    """The packed fingerprints of the texts."""
    made: list[bytes] = []
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or b"") + 64
        if held > BLOCK or i == len(texts) - 1:
            minima = densified(bin_minima(*shingle_hashes(texts[start : i + 1], WORDS), BIN_BITS))
            # Mixed with the bin: one shingle that fills many bins agrees by chance in a quarter of them, not in all or none.
            salt = mixed(np.arange(1, minima.shape[1] + 1, dtype=np.uint64))
            low = (mixed(minima ^ salt) & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint8)
            bits = np.unpackbits(low[:, :, None], axis=2, count=LOW_BITS, bitorder="little").reshape(len(low), -1)
            packed = np.packbits(bits, axis=1)
            made += [b"" if empty else row.tobytes() for row, empty in zip(packed, minima[:, 0] == EMPTY, strict=True)]
            start, held = i + 1, 0
    return made


def likeness_of(left: bytes, right: bytes) -> float:
    """The estimated Jaccard similarity, from 0 to 1."""
    if not left or not right:
        return float(left == right)
    differing = np.unpackbits(np.frombuffer(left, np.uint8) ^ np.frombuffer(right, np.uint8)).reshape(-1, LOW_BITS)
    agreed, chance = 1 - differing.any(axis=1).mean(), 2.0**-LOW_BITS
    return float(max(0.0, (agreed - chance) / (1 - chance)))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column, binary."""

    @F.arrow_udf("binary")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array(sketch(texts.cast(pa.binary()).to_pylist()), pa.binary())

    return made(text)


def likeness(left: Column, right: Column) -> Column:
    @F.arrow_udf("double")
    def compared(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([likeness_of(x or b"", y or b"") for x, y in pairs], pa.float64())

    return compared(left, right)


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], following: list[str]) -> dict[str, list]:
    """The result columns of texts, each with the text that follows it."""
    cut = [len(text) // 4 for text in texts]
    edited = [(text[: len(text) - n] + after[:n]).encode() for text, after, n in zip(texts, following, cut, strict=True)]
    prints, edits = sketch([text.encode() for text in texts]), sketch(edited)
    # The prints of following texts are those of the texts moved by one, but for the last.
    nexts = [*prints[1:], *sketch([following[-1].encode()])] if following[:-1] == texts[1:] else sketch([t.encode() for t in following])
    return {
        "doc_id": ids,
        "n_chars": [len(text) for text in texts],
        "edited_sha256": [hashlib.sha256(text).hexdigest() for text in edited],
        "fingerprint": prints,
        "edited_fingerprint": edits,
        "near_edited": [likeness_of(a, b) for a, b in zip(prints, edits, strict=True)],
        "near_next": [likeness_of(a, b) for a, b in zip(prints, nexts, strict=True)],
    }


_TYPES = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.binary(),
    "edited_fingerprint": pa.binary(), "near_edited": pa.float64(), "near_next": pa.float64(),
    "part": pa.int32(), "edge": pa.string(), "text": pa.string(),
}


def _batch(**columns: list) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(name, [None] * size), kind) for name, kind in _TYPES.items()], names=list(_TYPES)
    )


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a sorted partition next to the one behind it; the first and last texts leave as edges."""
    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        if not ids:
            continue
        if held is None:
            yield _batch(doc_id=ids[:1], part=[part], edge=["first"], text=texts[:1])
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = ids[-1], texts[-1]
        start = size = 0
        for i in range(len(ids) - 1):
            size += len(texts[i]) + 64
            if size > BLOCK or i == len(ids) - 2:
                yield _batch(**_compared(ids[start : i + 1], texts[start : i + 1], texts[start + 1 : i + 2]))
                start, size = i + 1, 0
    if held is not None:
        yield _batch(doc_id=[held[0]], part=[part], edge=["last"], text=[held[1]])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, following = (batch.column(name).to_pylist() for name in ("doc_id", "text", "following"))
        for at in range(len(ids)):
            made = _batch(**_compared(ids[at : at + 1], texts[at : at + 1], following[at : at + 1]))
            yield made.select(list(_TYPES)[:7])


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness to each other and to the next text.

    Documents are range-partitioned by id, so almost every next document lies in the same task; only the first and last
    text of each partition meet in a join. Null ids come last; equal ids stand in order of their texts' digests.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.md5("text")]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sorted_ = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    made = written(sorted_.mapInArrow(_along, f"{_RESULT}, part int, edge string, text string"), "fingerprints")
    first = made.where("edge = 'first'")
    # One row per partition; the last one's next is the first.
    nexts = first.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("_next"))
    following = first.select(F.col("part").alias("_next"), F.col("text").alias("following"))
    ends = made.where("edge = 'last'").select("doc_id", "text", "part").join(nexts, "part").join(following, "_next")
    whole = made.where("edge IS NULL").select(*list(_TYPES)[:7])
    return whole.union(ends.select("doc_id", "text", "following").mapInArrow(_ends, _RESULT))


def op8_fingerprints(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    hexed = lambda name: F.lower(F.hex(name)).alias(name)
    return edited_likeness(docs).select(
        "doc_id", "n_chars", "edited_sha256", hexed("fingerprint"), hexed("edited_fingerprint"), "near_edited", "near_next"
    )
