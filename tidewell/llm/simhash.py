"""Near-duplicate groups by SimHash, found with a pigeonring filter.

1. Every text becomes one 64-bit fingerprint: the majority, bit by bit, of the hashes of its word shingles, repeats
   included. Equal fingerprints are one class, so copies cost one row.
2. The bits stand on a ring of ``SEGMENTS`` segments. If two fingerprints differ in at most ``MOST`` bits, some segment
   starts a chain around the ring whose cumulative differences stay within proportional budgets: the first l segments
   differ in at most ``floor(l * MOST / SEGMENTS)`` bits, for every l. The first ``EXACT`` segments of such a chain are equal, so
   they are the key under which candidates meet; the longer chains prune them, and what is left is compared in full.
3. Fingerprints are range-partitioned by (key, fingerprint), so a crowded key lies in many partitions. A run of equal
   keys that is short and lies inside its partition is compared there. Runs that are long or touch the partition's ends
   go on: all their members agree in the key's bits, so the same filter holds on the ring of the remaining ones, which
   gives longer keys. When few bits remain a key has at most ``2 ** FREE`` members, and groups of that size are compared.
   Nothing is capped, and no pair of classes within ``MOST`` bits is missed.
4. A run gives only links that join what it has not joined before; the components of all links are the groups.

Defined results: a null, empty or blank text has fingerprint 0 and is linked like any other; a text with fewer words than a
shingle has its whole sequence as the one shingle; of equal rows each is a row; a null id is the least of its group only
if there is no other; an empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import session
from tidewell.llm.common import slices, written
from tidewell.llm.neardup import components
from tidewell.operators import skew

BITS = 64
SEED = 42
MOST = 2
SEGMENTS = 7
# Segments that a chain has equal before its budget allows a difference.
EXACT = (SEGMENTS - 1) // MOST
# Members of a run compared in place; longer runs get longer keys.
RUN = 256
# Free bits at which a key is no longer cut.
FREE = 13
# Bytes of text, and shingles, hashed at a time.
TEXT_BLOCK = 500_000
SHINGLE_BLOCK = 100_000
# Share of all rows from which a fingerprint's rows are spread in the last join.
HOT_SHARE = 0.01


def _votes(text: bytes | None, words: int) -> tuple[np.ndarray, int]:
    """How many of the shingles of a text have each bit, and how many there are."""
    parts = (text or b"").lower().split()
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if parts else sizes
    ends = starts + sizes
    if len(parts) > words:
        starts, ends = starts[: len(parts) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), SHINGLE_BLOCK):
        places = zip(starts[at : at + SHINGLE_BLOCK].tolist(), ends[at : at + SHINGLE_BLOCK].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in places], "<u8")
        # Byte by byte, a count of the 256 values holds the votes for eight bits.
        for i, column in enumerate(hashes.view(np.uint8).reshape(-1, 8).T):
            votes[8 * i : 8 * i + 8] += np.bincount(column, minlength=256) @ _BYTE_BITS
    return votes, len(starts)


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def simhash(text: bytes | None, words: int = 3) -> int:
    """The fingerprint as a signed number of 64 bits: a bit is 1 if it is set in over half the shingles."""
    votes, shingles = _votes(text, words)
    return int(np.bitwise_or.reduce(np.where(2 * votes > shingles, _WEIGHTS, np.uint64(0))).astype(np.int64))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (a long) of every row of ``docs`` (``doc_id, text``)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", TEXT_BLOCK):
            found = [simhash(text.as_py(), words) for text in piece.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, "doc_id long, fingerprint long")


# --- chains -----------------------------------------------------------------------------------


def _segments(mask: int) -> list[int]:
    """Masks of the segments into which the bits outside ``mask`` are cut, in order around the ring."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * i // SEGMENTS for i in range(SEGMENTS + 1)]
    return [sum(1 << b for b in free[low:high]) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


def _chain(segments: list[int], start: int, length: int) -> int:
    return sum(segments[(start + i) % SEGMENTS] for i in range(length))


def levels() -> list[list[tuple[int, list[tuple[int, int]]]]]:
    """Per level, the bits of every key and what its longer chains may differ in: (cumulative bits, budget).

    Key ``k`` of a level refines key ``k // SEGMENTS`` of the level before: its bits, and the equal beginning of the chain
    that starts at segment ``k % SEGMENTS`` of the bits that were free.
    """
    made: list[list[tuple[int, list[tuple[int, int]]]]] = []
    masks = [0]
    while any(BITS - mask.bit_count() > FREE for mask in masks):
        level = []
        for mask in masks:
            parts = _segments(mask)
            for start in range(SEGMENTS):
                budgets = [(_chain(parts, start, n), n * MOST // SEGMENTS) for n in range(EXACT + 1, SEGMENTS + 1)]
                level.append((mask | _chain(parts, start, EXACT), budgets))
        made.append(level)
        masks = [mask for mask, _ in level]
    return made


def _linked(prints: np.ndarray, keys: np.ndarray, runs: np.ndarray, level: list[tuple[int, list[tuple[int, int]]]]) -> Iterator[tuple[int, int]]:
    """Links that join the members of each run (``runs`` numbers them, in order), compared at growing distance."""
    above = np.arange(len(prints))
    left = np.cumsum(np.bincount(runs))[runs] - 1 - above
    low = above

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for step in range(1, int(left.max(initial=0)) + 1):
        low = low[left[low] >= step]
        open_ = low[above[low] != above[low + step]]
        apart = prints[open_] ^ prints[open_ + step]
        # The chain decides first; only what it leaves is compared in full.
        for key in np.unique(keys[open_]).tolist():
            mine = np.flatnonzero(keys[open_] == key)
            for bits, budget in level[key][1]:
                mine = mine[np.bitwise_count(apart[mine] & np.uint64(bits)) <= budget]
            for i in open_[mine[np.bitwise_count(apart[mine]) <= MOST]].tolist():
                a, b = top(i), top(i + step)
                if a != b:
                    above[max(a, b)] = min(a, b)
                    yield int(prints[i].astype(np.int64)), int(prints[i + step].astype(np.int64))
        above = above[above]


def _given(links: list[tuple[int, int]], keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    a = np.concatenate([np.array([x for x, _ in links], np.int64), prints.view(np.int64)])
    b = np.array([y for _, y in links] + [0] * len(prints), np.int64)
    key = np.concatenate([np.zeros(len(links), np.int64), keys])
    passed = np.arange(len(a)) >= len(links)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=passed), pa.array(key, mask=~passed)], names=["a", "b", "key"])


def _searched(keyed: DataFrame, level: list[tuple[int, list[tuple[int, int]]]], last: bool) -> DataFrame:
    """``a, b, key``: links (``key`` null), and with ``b`` null the members ``a`` of runs that need a longer key.

    ``keyed`` has ``key, value, fingerprint`` sorted within partitions. On the ``last`` level every run is whole.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(keys: np.ndarray, values: np.ndarray, prints: np.ndarray, starts: bool, ends: bool) -> pa.RecordBatch:
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (values[1:] != values[:-1])])
            runs = np.cumsum(new) - 1
            size = np.bincount(runs)
            later = np.full(len(size), False) if last else size > RUN
            # What touches an end of the partition may have members elsewhere.
            later[0] |= starts and not last
            later[-1] |= ends and not last
            here = ~later[runs] & (size[runs] > 1)
            numbers = np.cumsum(np.diff(runs[here], prepend=-1) != 0) - 1
            found = list(_linked(prints[here], keys[here], numbers, level))
            return _given(found, keys[later[runs]], prints[later[runs]])

        rows, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = (batch.column(c).to_numpy() for c in ("key", "value"))
            own = [keys, values, batch.column("fingerprint").to_numpy().view(np.uint64)]
            rows = own if rows is None else [np.concatenate(x) for x in zip(rows, own, strict=True)]
            # The last run may go on in the next batch.
            begun = int(np.searchsorted(-((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])).astype(np.int8)[::-1], 0, "left"))
            cut = len(rows[0]) - begun
            if cut:
                yield done(*[x[:cut] for x in rows], first, False)
                first, rows = False, [x[cut:] for x in rows]
            if not last and len(rows[0]) > 4 * RUN:
                # One long run so far: its members go on, but for a rest that shows that it is long.
                yield _given([], rows[0][: -2 * RUN], rows[2][: -2 * RUN])
                rows = [x[-2 * RUN :] for x in rows]
        if rows is not None:
            yield done(*rows, first, True)

    return keyed.select("key", "value", "fingerprint").mapInArrow(compared, "a long, b long, key long")


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: links that connect all of the distinct ``fingerprint`` values which differ in at most ``MOST`` bits."""
    plan = levels()
    found: list[DataFrame] = []
    waiting = prints.select("fingerprint", F.lit(0).cast("long").alias("key"))
    for level in plan:
        masks = F.lit([mask - (mask >> (BITS - 1) << BITS) for mask, _ in level])
        cut = waiting.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("_start"), "key")
        cut = cut.select("fingerprint", (F.col("key") * SEGMENTS + F.col("_start")).alias("key"))
        cut = cut.withColumn("value", F.col("fingerprint").bitwiseAND(F.get(masks, F.col("key"))))
        order = ["key", "value", "fingerprint"]
        last = level is plan[-1]
        spread = cut.repartition("key", "value") if last else cut.repartitionByRange(*order)
        made = written(_searched(spread.sortWithinPartitions(*order), level, last), "chains")
        found.append(made.where("b IS NOT NULL").select("a", "b"))
        waiting = made.where("b IS NULL").select(F.col("a").alias("fingerprint"), "key")
        if waiting.isEmpty():
            break
    return reduce(DataFrame.union, found)


def groups(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``; the fingerprint is a long."""
    rows = written(fingerprints(docs, words), "simhash")
    classes = session.durable(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    labels = components(links(classes.select("fingerprint"))).withColumnRenamed("id", "fingerprint")
    named = classes.join(labels, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = session.durable(named.join(least, "label").select("fingerprint", "component_id"))
    return skew.salted_join(rows, named, "fingerprint", factor=32, share=HOT_SHARE).select("doc_id", "fingerprint", "component_id")


def hexed(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return groups(docs).select("doc_id", hexed(F.col("fingerprint")).alias("fingerprint"), "component_id")
