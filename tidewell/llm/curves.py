"""Approximate nearest neighbours by largest inner product, over shifted space-filling curves.

1. Vectors that take no part go; equal vectors are one point that keeps its least ``k + 1`` ids, since more of them
   can never be among the ``k`` nearest of any query.
2. A further coordinate makes all points equally long, so the largest inner product is the least distance. Points
   are projected at random to few dimensions, shifted, and ordered along a Hilbert curve; each curve has its own
   projection and shift.
3. Points and queries are range-partitioned by (curve, key) and cut into blocks of ``BLOCK`` in order. A query visits
   the blocks around its own place on a curve; what lies there is ranked by the exact inner product, in double
   precision, and the best ``k`` of all blocks are merged.
4. How many curves and blocks a query visits is fitted: a bounded sample of queries is compared with all points,
   block by block, and the cheapest choice is taken whose recall reaches ``RECALL``, a little above the aim of 0.9.

On clustered vectors few blocks do. Independent directions in many dimensions have no neighbourhood that an order of
few dimensions could follow; there one curve and most of its blocks are visited, which is the price of the recall.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, as query or
candidate; vectors of another length than the most frequent one take none either; ties go to the smaller id; of equal
rows each is a candidate; a null id is none; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.common import written

NEAREST = 20
CURVES = 4
DIMENSIONS = 6
BITS = 10
BLOCK = 8_192
# Queries of a block that meet its points at once, and rows of their scores that are held at once (16 MB).
PACK = 512
SLICE = 256
# Queries whose true neighbours set the window, and the recall they must reach.
SAMPLE = 64
RECALL = 0.95


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of integer points (rows) on the Hilbert curve of so many bits a coordinate, as 64-bit integers.

    Skilling's transposed form: Gray-coded coordinates, whose bits interleave to the place.
    """
    x = cells.T.astype(np.uint64).copy()
    n = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        p = q - np.uint64(1)
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        flip = np.where((x[n - 1] & q) > 0, flip ^ (q - np.uint64(1)), flip)
        q >>= np.uint64(1)
    x ^= flip
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << np.uint64(1)) | ((x[i] >> np.uint64(bit)) & np.uint64(1))
    return place.astype(np.int64)


def keys(vectors: np.ndarray, lift: np.ndarray, curve: int) -> np.ndarray:
    """Keys of vectors on one curve; ``lift`` is the coordinate that makes all points equally long (0 for queries).

    Scaled by the common length, a projected coordinate lies within 1 of 0, and mostly within three standard
    deviations of a random direction; these are spread over the cells, the rest stays at the border.
    """
    rng = np.random.default_rng(1000 + curve)
    directions = np.linalg.qr(rng.normal(size=(vectors.shape[1] + 1, DIMENSIONS)))[0] if vectors.shape[1] >= DIMENSIONS else rng.normal(size=(vectors.shape[1] + 1, DIMENSIONS))
    spread = 3 / np.sqrt(vectors.shape[1] + 1)
    projected = np.column_stack([vectors, lift]) @ directions / spread + rng.uniform(-0.25, 0.25, DIMENSIONS)
    cells = np.clip((projected + 1.25) / 2.5 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.uint64)
    return hilbert(cells, BITS)


def _unit(column: pa.Array, longest: float) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1) / longest


def usable(rows: DataFrame) -> DataFrame:
    """``id, vector`` (doubles) of the rows that take part."""
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where("id IS NOT NULL AND size(vector) > 0").where(~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (length[0].n if length else 0))


def _points(rows: DataFrame, k: int) -> DataFrame:
    """``ids, bytes, norm`` of the different vectors, with their least ids."""

    @F.arrow_udf("binary")
    def packed(lists: pa.Array) -> pa.Array:
        return pa.array([(np.asarray(x.values, "<f8") + 0.0).tobytes() for x in lists], pa.binary())

    flat = rows.select("id", packed(F.col("vector")).alias("bytes"))
    place = F.row_number().over(Window.partitionBy("bytes").orderBy("id"))
    least = flat.withColumn("_place", place).where(F.col("_place") <= k + 1)
    points = least.groupBy("bytes").agg(F.sort_array(F.collect_list("id")).alias("ids"))

    @F.arrow_udf("double")
    def norm(vectors: pa.Array) -> pa.Array:
        return pa.array([float(np.linalg.norm(np.frombuffer(x.as_py(), "<f8"))) for x in vectors], pa.float64())

    return written(points.select("ids", "bytes", norm(F.col("bytes")).alias("norm")), "points")


def _keyed(points: DataFrame, longest: float, query: bool) -> DataFrame:
    """The points on every curve: ``curve, key`` before their columns."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(batch.column("bytes"), longest)
            lift = np.zeros(len(unit)) if query else np.sqrt(np.maximum(0, 1 - (unit**2).sum(axis=1)))
            for curve in range(CURVES):
                columns = [pa.array([curve] * len(unit), pa.int32()), pa.array(keys(unit, lift, curve)), *batch.columns]
                yield pa.RecordBatch.from_arrays(columns, names=["curve", "key", *batch.schema.names])

    return points.mapInArrow(made, "curve int, key long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema))


def _ordered(points: DataFrame, queries: DataFrame, longest: float) -> DataFrame:
    """``curve, block, query, ids, bytes``: points and queries in one order on every curve, so many to a block."""
    own = points.select(F.lit(None).cast("long").alias("query"), "ids", "bytes")
    asked = queries.select("query", F.lit(None).cast("array<long>").alias("ids"), "bytes")
    keyed = _keyed(own, longest, False).union(_keyed(asked, longest, True))
    order = ["curve", "key", "query", "ids"]
    placed = written(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "curve-points"
    )
    part = F.shiftright("_at", 33)
    pieces = placed.groupBy("curve", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # One row per curve and partition.
    earlier = Window.partitionBy("curve").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("curve", "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = placed.withColumn("_part", part).join(starts, ["curve", "_part"])
    block = F.floor((F.col("_at") + F.col("_shift")) / BLOCK).cast("int")
    return written(numbered.select("curve", block.alias("block"), "query", "ids", "bytes"), "curve-blocks")


def _best(query: np.ndarray, own: np.ndarray, points: np.ndarray, ids: list[np.ndarray], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its nearest points, ties to smaller ids, itself left out."""
    for i in range(len(query)):
        if i % SLICE == 0:
            scores = query[i : i + SLICE] @ points.T
        row = scores[i % SLICE]
        near = np.arange(len(row))
        if len(row) > k + 1:
            # Rounding may differ a little between products of matrices and of vectors: keep what is close to the last.
            last = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
            near = np.flatnonzero(row >= last - 1e-9 * max(1.0, abs(last)))
        exact = np.array([float(np.dot(points[j], query[i])) for j in near])
        sizes = [len(ids[j]) for j in near]
        every, score = np.concatenate([ids[j] for j in near]), np.repeat(exact, sizes)
        keep = every != own[i]
        every, score = every[keep], score[keep]
        order = np.lexsort([every, -score])[:k]
        yield every[order], score[order]


_FOUND = "query_id long, vec_id long, score double"


def _packs(visits: DataFrame) -> DataFrame:
    """``curve, block, queries``: the queries that visit a block, about ``PACK`` of them in a row at any number of queries."""
    # One row per block and curve.
    number = visits.groupBy("curve", "block").agg(F.ceil(F.count("*") / PACK).alias("_packs"))
    dealt = visits.join(F.broadcast(number), ["curve", "block"])
    packs = dealt.groupBy("curve", "block", F.pmod(F.xxhash64("query", "bytes"), F.col("_packs")).alias("_pack"))
    return packs.agg(F.collect_list(F.struct("query", "bytes")).alias("queries")).drop("_pack")


def _searched(visits: DataFrame, made: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of every block that a query visits (``curve, block, query, bytes``)."""
    met = _packs(visits).join(made.select("curve", "block", "ids", F.col("bytes").alias("points")), ["curve", "block"])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                query = np.frombuffer(b"".join(q["bytes"] for q in row["queries"]), "<f8").reshape(len(row["queries"]), -1)
                own = np.array([q["query"] for q in row["queries"]])
                points = np.frombuffer(b"".join(row["points"]), "<f8").reshape(len(row["points"]), -1)
                best = list(_best(query, own, points, [np.array(i) for i in row["ids"]], k))
                if best:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(own, [len(b[0]) for b in best])),
                            pa.array(np.concatenate([b[0] for b in best])),
                            pa.array(np.concatenate([b[1] for b in best])),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    return met.select("queries", "points", "ids").mapInArrow(ranked, _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``; a neighbour found on several curves counts once."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _fitted(homes: DataFrame, made: DataFrame, members: DataFrame, k: int) -> tuple[int, int]:
    """The number of curves, and of blocks on either side, that give a sample of queries the recall at the least cost.

    The truth comes from all blocks of one curve; what is gathered is one row per true neighbour and curve.
    """
    asked = homes.where("curve = 0").orderBy(F.xxhash64("query"), "query").limit(SAMPLE).select("query")
    sampled = written(homes.join(F.broadcast(asked), "query"), "sampled")
    first = made.where("curve = 0").select("curve", "block")
    everywhere = sampled.where("curve = 0").select("curve", "query", "bytes").join(first, "curve")
    truth = written(_top(_searched(everywhere, made, k), k).select("query_id", "vec_id"), "truth")
    found = members.select("curve", "block", F.explode("ids").alias("vec_id")).join(F.broadcast(truth), "vec_id")
    near = found.join(F.broadcast(sampled.select("curve", F.col("query").alias("query_id"), "home")), ["curve", "query_id"])
    away = near.groupBy("query_id", "vec_id", "curve").agg(F.min(F.abs(F.col("block") - F.col("home"))).alias("away"))
    by_pair: dict[tuple[int, int], list[int]] = {}
    for row in away.collect():
        by_pair.setdefault((row.query_id, row.vec_id), [1 << 30] * CURVES)[row.curve] = row.away
    if not by_pair:
        return 1, 0
    least = np.minimum.accumulate(np.array(list(by_pair.values())), axis=1)
    reach = np.quantile(least, RECALL, axis=0, method="higher").astype(int)
    blocks = made.where("curve = 0").count()
    cost = [(curve + 1) * min(2 * int(r) + 1, blocks) for curve, r in enumerate(reach)]
    best = int(np.argmin(cost))
    return best + 1, int(reach[best])


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of ``rows`` for each of ``queries`` (``vec_id, embedding``)."""
    points = _points(usable(rows), k)
    longest = points.agg(F.max("norm")).head()[0] or 1.0

    @F.arrow_udf("binary")
    def packed(lists: pa.Array) -> pa.Array:
        return pa.array([np.asarray(x.values, "<f8").tobytes() for x in lists], pa.binary())

    # Equal rows ask the same; once is enough, and copies of one query cannot be told apart when packs are dealt.
    asked = usable(queries).select(F.col("id").alias("query"), packed(F.col("vector")).alias("bytes")).distinct()
    ordered = _ordered(points, asked, longest)
    members = ordered.where("query IS NULL")
    grouped = members.groupBy("curve", "block").agg(F.collect_list(F.struct("ids", "bytes")).alias("points"))
    made = written(grouped.select("curve", "block", "points.ids", F.col("points.bytes").alias("bytes")), "blocks")
    homes = ordered.where("query IS NOT NULL").select("curve", "query", "bytes", F.col("block").alias("home"))
    curves, reach = _fitted(homes, made, members, k)
    last = ordered.groupBy("curve").agg(F.max("block").alias("_last"))
    visits = homes.where(F.col("curve") < curves).join(F.broadcast(last), "curve")
    # At the ends of a curve the window moves inwards, so that every query visits as many blocks.
    start = F.greatest(F.lit(0), F.least(F.col("home") - reach, F.col("_last") - 2 * reach))
    visits = visits.select("curve", "query", "bytes", F.explode(F.sequence(start, F.least(start + 2 * reach, F.col("_last")))).alias("block"))
    return _top(_searched(visits, made, k), k)


def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(rows, rows.where("vec_id % 20 = 0"))
