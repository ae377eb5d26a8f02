"""Removing repeated passages: blockwise suffix sorting with ranks of a difference-cover sample.

A byte goes if a string of 200 bytes over it starts anywhere else too. Only suffixes that can be repeated are sorted:

1. Every 200-byte window has an anchor, the 32-byte string in it with the least hash. Equal windows have equal anchors,
   so a window whose anchor occurs once is unique. One position in 85 is an anchor; their hashes are counted.
2. Suffix buckets are the repeated anchors. An occurrence brings the bytes of its windows; equal bytes seen by one task
   settle each other there, and one of them goes on.
3. A task sorts one block of buckets at a time. Suffixes are compared by 32 bytes; ties go to the ranks of two sample
   suffixes at a common distance, which a difference cover modulo 32 provides. So a block needs memory in proportion
   to itself, however long the repeats. Neighbours with 200 common bytes are repeats.
4. A bucket of more than ``HOT`` occurrences is split by where the anchor lies in the window and by the bytes that all
   such windows share, until parts are small or windows equal; equal bytes settle each other on the way.

Defined results: a null text is treated as empty; texts under 200 bytes keep everything; of equal texts of 200 bytes or
more nothing is kept; an empty table gives an empty table. Texts may be of any length below 256 MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidewell import session
from tidewell.llm.common import released, slices, written
from tidewell.llm.shingles import rolling_hashes

LENGTH = 200
GRAM = 32
GRAMS = LENGTH - GRAM + 1
# Occurrences of an anchor beyond which its bucket is split, and parts a split makes.
HOT = 2_000
FAN = 4
WIDEST = 256
# Bytes of text searched for anchors, and bytes of a block of suffix buckets, at a time.
TEXT_BLOCK = 600_000
SORT_BLOCK = 300_000
PERIOD = 32
_PLACE = np.uint64((1 << 28) - 1)


def _difference_cover(period: int) -> np.ndarray:
    """Residues among which every difference modulo ``period`` occurs; grown greedily."""
    cover, open_ = [0], set(range(1, period))
    while open_:
        gain = lambda x: len(open_ & {d % period for c in cover for d in (x - c, c - x)})
        best = max(range(1, period), key=gain)
        open_ -= {d % period for c in cover for d in (best - c, c - best)}
        cover.append(best)
    return np.array(sorted(cover))


COVER = _difference_cover(PERIOD)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
# Least distance from residues i and j to residues of the cover.
_DISTANCE = np.array([[next(k for k in range(PERIOD) if _IN_COVER[(i + k) % PERIOD] and _IN_COVER[(j + k) % PERIOD]) for j in range(PERIOD)] for i in range(PERIOD)])


def anchors(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined, where each starts, and the runs of windows with one anchor: text, first window, number, anchor's
    place in the first window, anchor's hash come as columns of equal length behind them."""
    joined = b"".join(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    none = np.zeros(0, np.int64)
    if len(joined) < LENGTH:
        return joined, ends - lengths, none, none, none, none.astype(np.uint64)
    grams = rolling_hashes(np.frombuffer(joined, np.uint8), GRAM)
    keys = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
    windows = len(grams) - GRAMS + 1
    # The least key of every window: of the rest of one stretch and the beginning of the next.
    stretches = np.concatenate([keys, np.full(-len(keys) % GRAMS, ~np.uint64(0))]).reshape(-1, GRAMS)
    heads = np.minimum.accumulate(stretches, axis=1).ravel()
    tails = np.minimum.accumulate(stretches[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tails[:windows], heads[GRAMS - 1 : GRAMS - 1 + windows])
    text = np.repeat(np.arange(len(texts)), lengths)[:windows]
    start = np.flatnonzero(np.arange(windows) + LENGTH <= ends[text])
    anchor = (least[start] & _PLACE).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor, prepend=-1))
    number = np.diff(np.append(cut, len(start)))
    first = start[cut]
    return joined, ends - lengths, first, number, anchor[cut] - first, grams[anchor[cut]]


def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))


def _anchor_hashes(docs: DataFrame) -> DataFrame:
    """``digest, copies, hashes`` of every different text that has windows."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", TEXT_BLOCK):
            texts = piece.column("text").cast(pa.binary()).to_pylist()
            _, starts, first, _, _, hashes = anchors(texts)
            bounds = np.searchsorted(first, np.append(starts, 1 << 62))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([piece.column("digest"), lists], names=["digest", "hashes"])

    found = _text_rows(docs).where(F.octet_length("text") >= LENGTH).mapInArrow(released(made), "digest binary, hashes array<long>")
    return found.groupBy("digest").agg(F.count("*").alias("copies"), F.first("hashes").alias("hashes"))


def compressed(text: Column) -> Column:
    """A text's bytes in zstd, smaller than a shuffle's own compression makes them."""

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(3)
        return pa.array([press.compress(x.as_py() or b"") for x in texts.cast(pa.binary())], pa.binary())

    return packed(text)


_SUFFIXES = "key long, digest binary, start long, number long, place long, bytes binary, settled boolean"


def _occurrences(texts: DataFrame) -> DataFrame:
    """The windows of repeated anchors. With ``key``: bytes that still look for an equal window elsewhere, or are
    ``settled`` and only wait to be found. Without: windows that have found one here."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("packed")).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (TEXT_BLOCK // 3), prepend=0))
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if end > start:
                    yield from _settle(batch.slice(start, end - start))

    return texts.mapInArrow(released(made), _SUFFIXES)


def _settle(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = [zstandard.decompress(x) for x in batch.column("packed").to_pylist()]
    digests, copies = batch.column("digest").to_pylist(), batch.column("copies").to_pylist()
    repeated = np.unique(batch.column("hashes").values.to_numpy(zero_copy_only=False))
    joined, starts, first, number, place, hashes = anchors(texts)
    mine = np.flatnonzero(np.isin(hashes.view(np.int64), repeated))
    text = np.searchsorted(starts, first[mine], side="right") - 1
    seen: dict[bytes, int] = {}
    rows: list[list] = []
    found: list[list] = []
    for t, at, n, o, h in zip(text.tolist(), first[mine].tolist(), number[mine].tolist(), place[mine].tolist(), hashes[mine].view(np.int64).tolist(), strict=True):
        window = joined[at : at + n + LENGTH - 1]
        row = [h, digests[t], at - int(starts[t]), n, o, window, copies[t] > 1]
        twin = seen.setdefault(window, len(rows))
        if twin == len(rows):
            rows.append(row)
            continue
        for one in (rows[twin], row):
            if not one[6]:
                found.append([None, *one[1:5], None, True])
                one[6] = True
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    names = ["key", "digest", "start", "number", "place", "bytes", "settled"]
    columns = zip(*rows, *found, strict=True) if rows else [[]] * 7
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def repeated_windows(block: bytes, starts: np.ndarray) -> np.ndarray:
    """Whether the 200 bytes at each start occur at another start; by sorting the suffixes of the block there."""
    n = len(block)
    padded = np.frombuffer(block + bytes(8 * LENGTH), np.uint8)
    word = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))

    def ranks(*keys: np.ndarray) -> np.ndarray:
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    # Ranks of the sample by 32, 64, 128 and 256 bytes: a sample suffix moved by the period is a sample suffix.
    sample = np.flatnonzero(_IN_COVER[np.arange(n) % PERIOD])
    rank = np.zeros(n + LENGTH + 2 * PERIOD + 256, np.int64)
    rank[sample] = 1 + ranks(*[word[sample + k] for k in range(0, PERIOD, 8)])
    step = PERIOD
    while step < LENGTH:
        rank[sample] = 1 + ranks(rank[sample], rank[sample + step])
        step *= 2

    order = np.lexsort([word[starts + k] for k in range(PERIOD - 8, -1, -8)])
    new = np.ones(len(order), bool)
    at = starts[order]
    new[1:] = False
    for k in range(0, PERIOD, 8):
        new[1:] |= word[at[1:] + k] != word[at[:-1] + k]
    # Classes of equal suffixes, in order; ties are split around a pivot until every class is settled.
    tie = np.cumsum(new) - 1
    tied_32 = tie.copy()
    same = np.zeros(len(order), bool)
    open_ = np.bincount(tie)[tie] > 1
    while open_.any():
        where = np.flatnonzero(open_)
        group = tie[where]
        head = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(np.append(head, len(group)))
        pivot = np.repeat(at[where][head + size // 2], size)
        x = at[where]
        k = _DISTANCE[x % PERIOD, pivot % PERIOD]
        side = np.sign(rank[x + k] - rank[pivot + k])
        moved = np.lexsort([side, group])
        at[where], order[where] = x[moved], order[where][moved]
        side, group = side[moved], group[moved]
        split = np.ones(len(group), bool)
        split[1:] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        new_tie = np.cumsum(split)
        count = np.bincount(new_tie)[new_tie]
        same[where] = (side == 0) & (count > 1)
        open_[where] = (side != 0) & (count > 1)
        # Numbers only have to tell groups apart.
        tie[where] = tie.max() + new_tie
    # Suffixes that part after 200 bytes or more are neighbours in the order.
    close = np.flatnonzero((tied_32[1:] == tied_32[:-1]) & ~(same[1:] & same[:-1] & (tie[1:] == tie[:-1])))
    for k in range(PERIOD, LENGTH, 8):
        close = close[word[at[close] + k] == word[at[close + 1] + k]]
    same[close] = same[close + 1] = True
    result = np.zeros(len(order), bool)
    result[order] = same
    return result


def _runs(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set flags that do not cross the bounds: row, first place in the row, number."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    on = np.flatnonzero(flags)
    cut = np.flatnonzero((np.diff(on, prepend=-2) != 1) | (np.diff(row[on], prepend=-1) != 0))
    number = np.diff(np.append(cut, len(on)))
    first = on[cut]
    return row[first], first - bounds[row[first]], number


def _sorted_blocks(rows: DataFrame) -> DataFrame:
    """``digest, start, number`` of the windows that equal another one of their bucket."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            data = block.column("bytes").to_pylist()
            number = block.column("number").to_numpy()
            base = np.cumsum([0, *map(len, data)])[:-1]
            bounds = np.concatenate([[0], np.cumsum(number)])
            starts = np.repeat(base - bounds[:-1], number) + np.arange(bounds[-1])
            flags = repeated_windows(b"".join(data), starts)
            flags &= np.repeat(~block.column("settled").to_numpy(zero_copy_only=False), number)
            row, first, count = _runs(flags, bounds)
            start = block.column("start").to_numpy()[row] + first
            yield pa.RecordBatch.from_arrays(
                [block.column("digest").take(pa.array(row)), pa.array(start), pa.array(count)], names=["digest", "start", "number"]
            )

    columns = ["key", "digest", "start", "number", "bytes", "settled"]
    # By a hash of the key: behind a join on the key Spark leaves out repartition("key"), and may then split a skewed
    # partition of that join, which tears a bucket over tasks.
    dealt = rows.select(*columns).repartition(F.xxhash64("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(released(made), "digest binary, start long, number long")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets of a sorted partition, together about SORT_BLOCK bytes or one larger bucket."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        sizes = np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy().astype(np.int64))
        begins = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if not held else held[-1].column("key")[-1].as_py()) != 0).tolist()
        start = 0
        for at in begins:
            now = size + int(sizes[at - 1] if at else 0) - int(sizes[start - 1] if start else 0)
            if now >= SORT_BLOCK:
                held.append(batch.slice(start, at - start))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, start = [], 0, at
        held.append(batch.slice(start))
        size += int(sizes[-1]) - int(sizes[start - 1] if start else 0)
        held = [b for b in held if b.num_rows]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _split(rows: DataFrame, part: int, width: int) -> DataFrame:
    """The windows in which the anchor lies in one part of the bucket's places, by the bytes that all of these share."""
    low = F.col("low") + part * width
    place = F.least(F.col("place"), low + width - 1)
    skipped = F.col("place") - place
    number = place - F.greatest(F.col("place") - F.col("number") + 1, low) + 1
    cut = rows.select(
        "key", "digest", (F.col("start") + skipped).alias("start"), number.alias("number"), place.alias("place"), "settled",
        F.substring("bytes", (skipped + 1).cast("int"), (number + LENGTH - 1).cast("int")).alias("bytes"), low.alias("low"),
    )
    shared = F.substring("bytes", (F.col("place") - F.col("low") + 1).cast("int"), F.lit(LENGTH + 1 - width))
    return cut.where("number > 0").withColumn("key", F.xxhash64("key", "low", shared))


def _split_buckets(hot: DataFrame) -> list[DataFrame]:
    """``digest, start, number`` of repeated windows in buckets too large for a task, in several frames.

    Each round settles equal bytes, sorts what has become small and splits the rest. At width 1 a bucket's windows
    have all their bytes in common, so no bucket is left.
    """
    found, width = [], WIDEST
    parts = hot.withColumn("low", F.lit(0).cast("long"))
    while True:
        parts = written(parts, "hot-suffixes")
        equal = parts.groupBy("key", "bytes").agg(
            F.count("*").alias("_equal"), F.max("settled").alias("settled"), F.min(F.struct("digest", "start", "number", "place", "low")).alias("_one")
        )
        equal = written(equal, "equal-suffixes")
        many = equal.where("_equal > 1").select("key", "bytes")
        found.append(parts.where("NOT settled").join(many, ["key", "bytes"]).select("digest", "start", "number"))
        one = equal.select("key", "_one.*", (F.col("settled") | (F.col("_equal") > 1)).alias("settled"), "bytes")
        sized = one.join(equal.groupBy("key").agg(F.count("*").alias("_size")).where("_size > 1"), "key")
        found.append(_sorted_blocks(sized.where(F.col("_size") <= HOT)))
        left = sized.where(F.col("_size") > HOT).drop("_size")
        if width == 1 or left.isEmpty():
            return found
        width //= FAN
        parts = _split(left, 0, width)
        for part in range(1, FAN):
            parts = parts.union(_split(left, part, width))


def repeats(docs: DataFrame) -> DataFrame:
    """``digest, copies, spans`` of every different text of 200 bytes or more that has repeated windows: the windows'
    bytes as unordered, overlapping spans. ``digest`` is the text's MD5; of a text with copies all is repeated."""
    hashes = written(_anchor_hashes(docs), "anchors")
    occurring = hashes.select("digest", F.explode("hashes").alias("hash"))
    twice = occurring.groupBy("hash").agg(F.count("*").alias("_times")).where("_times > 1").select("hash")
    # Keyed by 8 bytes of digest: if two texts share them, both are searched for the anchors of both, which is harmless.
    short = F.xxhash64("digest")
    suspect = hashes.select(short.alias("_short"), F.explode("hashes").alias("hash")).distinct().join(twice, "hash")
    wanted = suspect.groupBy("_short").agg(F.collect_list("hash").alias("hashes"))
    wanted = hashes.select("digest", "copies", short.alias("_short")).join(wanted, "_short").drop("_short")
    texts = _text_rows(docs).where(F.octet_length("text") >= LENGTH).select("digest", compressed(F.col("text")).alias("packed"))
    texts = texts.groupBy("digest").agg(F.first("packed").alias("packed")).join(wanted, "digest")
    rows = written(_occurrences(texts), "suffixes")

    waiting = rows.where("key IS NOT NULL")
    size = session.durable(waiting.groupBy("key").agg(F.count("*").alias("_size")).where(F.col("_size") > HOT).select("key"))
    found = [rows.where("key IS NULL").select("digest", "start", "number")]
    if size.isEmpty():
        found.append(_sorted_blocks(waiting))
    else:
        # At most one key in HOT rows is hot, and each is 8 bytes: by broadcast, the rows and their bytes are dealt once, for sorting.
        crowded = F.broadcast(size)
        found.append(_sorted_blocks(waiting.join(crowded, "key", "left_anti")))
        found += _split_buckets(waiting.join(crowded, "key", "left_semi"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    spans = every.groupBy("digest").agg(F.collect_list(F.struct("start", (F.col("start") + F.col("number") + LENGTH - 1).alias("end"))).alias("spans"))
    copied = hashes.where("copies > 1").select("digest", "copies")
    return spans.join(copied, "digest", "full")


def _cut(text: bytes, spans: np.ndarray, all_: bool) -> tuple[bytes, int, int]:
    """What is kept, and the number of bytes and of runs that go."""
    if all_:
        return b"", len(text), 1
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    gone = np.cumsum(change[:-1]) > 0
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return kept, len(text) - len(kept), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(text) else 0


def without_repeats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row with ``kept`` (binary), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    found = repeats(docs.select("text")).withColumnRenamed("digest", "_digest")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), digest.alias("_digest"), compressed(F.col("text")).alias("packed"))
    met = rows.join(found, "_digest", "left").select("_row", "packed", "copies", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed, copies, spans in zip(*(batch.column(c) for c in ("packed", "copies", "spans")), strict=True):
                text = zstandard.decompress(packed.as_py())
                pairs = np.zeros((0, 2), np.int64)
                if spans.is_valid:
                    ends = spans.values.flatten()
                    pairs = np.column_stack([e.to_numpy() for e in ends])
                kept = (text, 0, 0) if not spans.is_valid and not copies.is_valid else _cut(text, pairs, copies.is_valid)
                out.append((kept[0], len(text), *kept[1:]))
            kept, n_bytes, removed, runs = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, runs))],
                names=["_row", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    counts = [StructField(name, LongType()) for name in ("n_bytes", "n_removed", "n_spans")]
    return met.mapInArrow(released(cut), StructType([met.schema["_row"], StructField("kept", BinaryType()), *counts]))


def op4_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = without_repeats(docs, ["doc_id"])
    return found.select("_row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
