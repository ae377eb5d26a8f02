"""Near-duplicate groups by HyperMinHash registers, banding, a corrected estimate and an exact check.

1. A text becomes its set of hashed word shingles. Texts with one set are one class, so copies cost one row.
2. A class keeps 256 registers. A shingle hash chooses a bin by its first bits; the bin keeps the leading zeros (6 bits)
   and the next 10 bits of its least remainder. Empty bins are filled from filled ones.
3. Bands of 6 registers are keys. Sets of similarity 0.8 share none of 42 keys with probability 3e-6 (1e-9 at 0.85).
4. Every class of a bucket is a candidate with the bucket's least class, so a bucket gives as many pairs as it has
   members. Agreeing registers, corrected for chance collisions, must allow the similarity within five standard
   errors; what is left is confirmed on full sets, and components are formed.
5. Buckets whose classes are still in different components are compared completely, but only across components, in
   blocks, by registers and then by full sets; the members of a bucket's largest component meet only the others
   and are copied to the blocks of these alone. So no pair that shares a bucket and is not connected anyway goes
   unchecked, however many members a bucket has, and a bucket gives no more links than it has members.

Defined results: null, empty and blank texts have the empty set and are linked with nothing; a text with fewer words
than a shingle has its whole sequence as the one shingle; rows with equal texts are one group; a null id is never the
least of its group unless there is no other, and is not kept by id; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell import session
from tidewell.llm.common import release, released, slices, written
from tidewell.llm.shingles import bin_minima, densified, mixed, shingle_hashes

BIN_BITS = 8
REGISTERS = 1 << BIN_BITS
MANTISSA = 10
BAND = 6
BANDS = REGISTERS // BAND
# Similarity in hundredths from which two texts are linked.
SIMILAR = 80
# Standard errors by which an estimate may fall short of SIMILAR before the exact check.
SLACK = 5.0
# Members of a bucket compared with each other at a time.
BLOCK = 512
_BAND_OF = np.uint64(63)
# Bytes of text hashed at a time.
TEXT_BLOCK = 500_000


def registers_of(minima: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa bits of 56-bit remainders, as 16-bit numbers."""
    width = 64 - BIN_BITS
    length = np.zeros(minima.shape, np.uint64)
    rest = minima.copy()
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >= np.uint64(1 << step)
        length += high.astype(np.uint64) * np.uint64(step)
        rest = np.where(high, rest >> np.uint64(step), rest)
    length += (rest > 0).astype(np.uint64)
    aligned = minima << (np.uint64(width) - length)
    mantissa = (aligned >> np.uint64(width - 1 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    return (((np.uint64(width) - length) << np.uint64(MANTISSA)) | mantissa).astype("<u2")


def _distinct(texts: list[bytes | None], words: int) -> Iterator[np.ndarray]:
    hashes, offsets = shingle_hashes(texts, words)
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        yield np.unique(hashes[start:end])


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, digest, n_shingles, set_key, registers`` of every row; the last two null for empty sets."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", TEXT_BLOCK):
            sets = list(_distinct(piece.column("text").cast(pa.binary()).to_pylist(), words))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            registers = registers_of(densified(bin_minima(np.concatenate(sets), offsets, BIN_BITS)))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            packed = [row.tobytes() if len(s) else None for row, s in zip(registers, sets, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("digest"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(packed, pa.binary()),
                ],
                names=["doc_id", "digest", "n_shingles", "set_key", "registers"],
            )

    schema = "doc_id long, digest binary, n_shingles long, set_key binary, registers binary"
    return docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("digest")).mapInArrow(released(made), schema)


def _bands(classes: DataFrame) -> DataFrame:
    """``key, id``: a row for each band of each class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            for piece in (batch.slice(at, 2000) for at in range(0, batch.num_rows, 2000)):
                matrix = np.frombuffer(b"".join(piece.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
                bands = matrix[:, : BANDS * BAND].reshape(-1, BANDS, BAND).astype(np.uint64)
                keys = np.broadcast_to(salts, bands.shape[:2])
                for i in range(BAND):
                    keys = mixed(keys ^ bands[:, :, i])
                ids = np.repeat(piece.column("id").to_numpy(), BANDS)
                # The last bits of a key are its band's number.
                keys = (keys & ~_BAND_OF) | np.arange(BANDS, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["key", "id"])

    return classes.select("id", "registers").mapInArrow(released(cut), "key long, id long")


def estimated(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Jaccard similarity by agreeing registers, less those that agree by chance in unrelated sets of these sizes."""
    zeros = 2.0 ** -np.arange(40)
    rate = lambda n: np.maximum(n / REGISTERS, 1.0)[..., None]
    share = lambda n: (1 - zeros[1:]) ** rate(n) - (1 - zeros[:-1]) ** rate(n)
    chance = (share(n_left) * share(n_right)).sum(axis=-1) / (1 << MANTISSA)
    agreed = (left == right).mean(axis=-1)
    return (agreed - chance) / (1 - chance)


def _allowed(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Whether sizes and registers allow the similarity; small sets have fewer independent registers."""
    least, most = np.minimum(n_left, n_right), np.maximum(n_left, n_right)
    goal = SIMILAR / 100
    error = np.sqrt(goal * (1 - goal) / np.minimum(least, REGISTERS))
    return (100 * least >= SIMILAR * most) & (estimated(left, right, n_left, n_right) >= goal - SLACK * error)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def _plausible(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    @F.arrow_udf("boolean")
    def allowed(left: pa.Array, right: pa.Array, n_left: pa.Array, n_right: pa.Array) -> pa.Array:
        parts = [np.zeros(0, bool)]
        for at in range(0, len(left), 2000):
            one, two, n, m = (x.slice(at, 2000) for x in (left, right, n_left, n_right))
            parts.append(_allowed(_matrix(one), _matrix(two), n.to_numpy(), m.to_numpy()))
        return pa.array(np.concatenate(parts))

    return allowed(a, b, n_a, n_b)


def similar(a: Column, b: Column, words: int) -> Column:
    """Whether the full shingle sets of two texts have the similarity."""

    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        last, one, found = None, None, []
        for x, y in zip(left.cast(pa.binary()), right.cast(pa.binary()), strict=True):
            x, y = x.as_py(), y.as_py()
            if x != last:
                last, one = x, next(_distinct([x], words))
            two = next(_distinct([y], words))
            both = len(np.intersect1d(one, two, assume_unique=True))
            found.append(100 * both >= SIMILAR * (len(one) + len(two) - both))
        release()
        return pa.array(found, pa.bool_())

    return linked(a, b)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs ``a, b`` whose texts are similar; ``texts`` has ``id, text``."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("_left"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("_right"))
    return pairs.join(right, "b").join(left, "a").where(similar(F.col("_left"), F.col("_right"), words)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` for every end of an edge ``a, b``: the least id of its component.

    Rounds of least labels over edges, then of labels of labels, so long chains shrink by powers of two.
    """
    both = session.durable(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = session.durable(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("id").alias("a"), F.col("label").alias("_near")), "a")
        least = near.groupBy(F.col("b").alias("id")).agg(F.min("_near").alias("_least"))
        lower = labels.join(least, "id").select("id", "label", F.least("label", "_least").alias("_lower"))
        jump = labels.select(F.col("id").alias("_lower"), F.col("label").alias("_jump"))
        moved = session.durable(lower.join(jump, "_lower").select("id", F.least("_lower", "_jump").alias("_new"), "label"))
        labels = moved.select("id", F.col("_new").alias("label"))
        if moved.where("_new <> label").isEmpty():
            return labels


def _apart(members: DataFrame) -> DataFrame:
    """``key, _size, _crowd, _crowded`` of the buckets of ``members`` (``key, id, label``) that hold several labels: how many
    members, the label of most of them, and how many these are."""
    sized = members.groupBy("key", "label").agg(F.count("*").alias("_n"))
    buckets = sized.groupBy("key").agg(F.sum("_n").alias("_size"), F.max(F.struct("_n", "label")).alias("_top"), F.count("*").alias("_labels"))
    return buckets.where("_labels > 1").select("key", "_size", F.col("_top.label").alias("_crowd"), F.col("_top._n").alias("_crowded"))


def _dealt(members: DataFrame) -> DataFrame:
    """``key, id, label, _own, _lower, _low, _high``: the groups in which the members of buckets with several labels meet.

    A bucket of up to BLOCK members is one group. Of a larger one, the members of its most frequent label are settled among
    themselves and need each other in no group: they are dealt to the upper blocks, all others to the lower ones, and a
    lower block meets every block. So a group holds two blocks at most, and only members outside the crowd go to several
    of the crowd's blocks.
    """
    known = members.join(_apart(members), "key")
    large, crowded = F.col("_size") > BLOCK, F.col("label") == F.col("_crowd")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    lower = F.when(large, blocks(F.col("_size") - F.col("_crowded"))).otherwise(1)
    upper = F.when(large, blocks(F.col("_crowded"))).otherwise(0)
    sized = known.select("key", "id", "label", lower.alias("_lower"), upper.alias("_upper"), (large & crowded).alias("_above"))
    spread = F.hash("id")
    own = F.when(F.col("_above"), F.col("_lower") + F.pmod(spread, F.col("_upper"))).otherwise(F.pmod(spread, F.col("_lower")))
    # A lower block meets itself in the group of the first upper one.
    last = F.when(F.col("_above"), F.col("_lower")).otherwise(F.col("_lower") + F.col("_upper")) - 1
    others = F.filter(F.sequence(F.lit(0), last), lambda x: (x != F.col("_own")) | (F.col("_upper") == 0))
    met = sized.withColumn("_own", own).select("key", "id", "label", "_own", "_lower", F.explode(others).alias("_other"))
    group = [F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high")]
    return met.select("key", "id", "label", "_own", "_lower", *group)


def _across(members: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Links ``a, b`` that join different labels of a bucket; as many at most as the bucket has members.

    ``members`` has ``key, id, label``; see :func:`_dealt` for who meets whom. Two classes are compared in the first of
    their common buckets, if their registers allow the similarity and nothing has joined their labels before.
    """
    met = written(_dealt(members), "met")
    wanted = met.select("id").distinct()
    full = classes.select("id", "n_shingles", "registers").join(wanted, "id").join(texts, "id")
    met = met.join(full, "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["key", "_low", "_high"]):
            found = list(_joining(group, words))
            if found:
                a, b = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    order = ["key", "_low", "_high"]
    return met.repartition(*order).sortWithinPartitions(*order).mapInArrow(released(compared), "a long, b long")


def _joining(group: pa.Table, words: int) -> Iterator[tuple[int, int]]:
    ids, labels, n, own = (group.column(x).to_numpy() for x in ("id", "label", "n_shingles", "_own"))
    matrix, text = _matrix(group.column("registers")), group.column("text").cast(pa.binary())
    band = group.column("key")[0].as_py() & int(_BAND_OF)
    low, high, lower = (group.column(x)[0].as_py() for x in ("_low", "_high", "_lower"))
    # Members of the low block meet each other in one group only.
    among = low if high in (low, lower) else None
    sets: dict[int, np.ndarray] = {}

    def set_of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = next(_distinct([text[i].as_py()], words))
        return sets[i]

    joined = labels.copy()
    for i in range(len(ids) - 1):
        j = np.arange(i + 1, len(ids))
        j = j[(joined[j] != joined[i]) & ((own[j] != own[i]) | (own[i] == among))]
        if not len(j):
            continue
        j = j[_allowed(matrix[i], matrix[j], n[i], n[j])]
        shared = (matrix[i] == matrix[j])[:, : BANDS * BAND].reshape(-1, BANDS, BAND).all(axis=2)
        for k in j[shared.argmax(axis=1) == band].tolist():
            if joined[k] == joined[i]:
                continue
            one, two = set_of(i), set_of(k)
            both = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * both >= SIMILAR * (len(one) + len(two) - both):
                joined[joined == joined[k]] = joined[i]
                yield int(ids[i]), int(ids[k])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted partition."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            piece = batch.slice(start, end - start)
            if held and any(held[0].column(k)[0] != piece.column(k)[0] for k in keys):
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def groups(docs: DataFrame, words: int = 5) -> DataFrame:
    """``doc_id, digest, n_shingles, label, component_id`` of every row of ``docs`` (``doc_id, text``).

    ``label`` names the group (null for the empty set), ``component_id`` is its least id, ``digest`` the text's MD5.
    """
    sketches = written(_sketches(docs, words), "sketches")
    rows = sketches.select("doc_id", "digest", "n_shingles", "set_key")
    known = sketches.where("set_key IS NOT NULL").groupBy("set_key")
    known = known.agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.min(F.struct("digest", "registers")).alias("_one")
    )
    classes = written(
        known.select(F.monotonically_increasing_id().alias("id"), "set_key", "least", "n_shingles", "_one.digest", "_one.registers"),
        "classes",
    )
    bands = _bands(classes)
    leads = bands.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("size")).where("size > 1")
    members = written(bands.join(leads, "key").select("key", "lead", "size", "id"), "members")

    wanted = members.select("id").distinct().join(classes.select("id", "digest"), "id")
    found = docs.select(F.unhex(F.md5("text")).alias("digest"), "text").join(wanted, "digest")
    texts = written(found.groupBy("id").agg(F.first("text").alias("text")), "texts")

    signs = classes.select("id", "n_shingles", "registers")
    stars = members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    right = signs.select(F.col("id").alias("b"), F.col("n_shingles").alias("_n_b"), F.col("registers").alias("_b"))
    left = signs.select(F.col("id").alias("a"), F.col("n_shingles").alias("_n_a"), F.col("registers").alias("_a"))
    likely = stars.join(right, "b").join(left, "a").where(_plausible(F.col("_a"), F.col("_b"), F.col("_n_a"), F.col("_n_b")))
    links = session.durable(_confirmed(likely.select("a", "b"), texts, words))
    labels = components(links)

    # Buckets of two are settled; of larger ones, those that still hold several components.
    placed = members.where("size > 2").select("key", "id").join(labels, "id", "left")
    placed = session.durable(placed.select("key", "id", F.coalesce("label", "id").alias("label")))
    more = session.durable(_across(placed, classes, texts, words))
    if not more.isEmpty():
        labels = components(links.union(more))

    named = classes.join(labels, "id", "left").select("set_key", F.coalesce("label", "id").alias("label"), "least")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = session.durable(named.join(least, "label").select("set_key", "label", "component_id"))
    return rows.join(named, "set_key", "left").select(
        "doc_id", "digest", "n_shingles", "label", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = 5) -> DataFrame:
    """``docs`` with one document of each group, the one with the least id; texts without words all stay."""
    decided = groups(docs.select("doc_id", "text"), words)
    chosen = decided.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "digest")).alias("_one"))
    chosen = chosen.where("label IS NOT NULL").select("_one.doc_id", "_one.digest")
    chosen = chosen.select(F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest"))
    keyed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.unhex(F.md5("text")).alias("_digest"))
    wordless = ~F.coalesce(F.col("_row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    met = keyed.where(~wordless).join(
        chosen, [F.col("_id").eqNullSafe(F.col("_kept_id")), F.col("_digest").eqNullSafe(F.col("_kept_digest"))]
    )
    # Equal rows meet the same choice; one of them stays.
    once = met.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_digest").orderBy(F.lit(1)))).where("_nth = 1")
    return once.select("_row.*").union(keyed.where(wordless).select("_row.*"))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = groups(docs, words=4)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
