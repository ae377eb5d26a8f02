"""Whitening of embeddings by the eigenvectors of their covariance.

1. Entries become whole numbers; each distinct vector is kept once, packed, as the fit list.
2. Sums per dimension are whole numbers. Every vector is centred at the rounded mean, products of centred entries are
   added up per task, exactly, and the tasks' sums, one per pair of dimensions, are added up by Spark as decimals. What
   the rounded mean has left of the centre is taken away in whole numbers too: the covariance has no rounding error, and
   does not depend on how the rows are dealt.
3. Its eigenvectors are found in float32 and corrected by the iteration of Ogita and Aishima: a few matrix
   multiplications in higher precision per round, each of which doubles the right digits. Eigenvalues that lie too close for the
   iteration form a cluster; the directions of a cluster are told apart by an eigenproblem of its own size, shifted to
   the cluster, and iterated on.
4. The vectors are centred, projected and scaled where they are read. The covariance of the result over the fit list
   is measured in a pass of its own.

Only sums leave the tasks: the driver holds matrices of dimension x dimension, at any number of rows.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; equal vectors count once in
the fit and are each whitened; a null id stays null; a component without variance has no direction to scale and is left
out, so a table with one distinct vector gives no rows; an empty table gives an empty table; vectors of several
lengths have no common covariance, and entries or deviations outside the long range no long: these are errors. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import written

# Entries are counted in 64ths and moved by a million.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# Rows multiplied at a time.
BLOCK = 4_096
ROUNDS = 30
# Errors by which two eigenvalues must differ for the iteration to treat them as simple.
APART = 16


# --- eigenvectors -----------------------------------------------------------------------------


def _clusters(values: np.ndarray, apart: np.longdouble) -> list[np.ndarray]:
    """Runs of at least two sorted values whose neighbours are within ``apart``."""
    runs = np.split(np.arange(len(values)), np.flatnonzero(np.diff(values) > apart) + 1)
    return [run for run in runs if len(run) > 1]


def refined(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to the precision of long doubles.

    The start is an eigendecomposition in float32.
    """
    size = len(matrix)
    high = np.asarray(matrix, np.longdouble)
    scale = np.abs(high).max(initial=0)
    if not scale:
        return np.zeros(size, np.longdouble), np.eye(size, dtype=np.longdouble)
    high = high / scale
    eye = np.eye(size, dtype=np.longdouble)
    vectors = np.linalg.eigh(high.astype(np.float32))[1].astype(np.longdouble)
    least = np.finfo(np.longdouble).eps * size
    before = np.inf
    for _ in range(ROUNDS):
        off = eye - vectors.T @ vectors
        turned = vectors.T @ (high @ vectors)
        # Rounding must not differ across the diagonal: divided by a small gap it would spoil orthogonality.
        turned = (turned + turned.T) / 2
        values = np.diag(turned) / (1 - np.diag(off))
        order = np.argsort(values, kind="stable")
        if (np.diff(order) < 0).any():
            vectors, values = vectors[:, order], values[order]
            off, turned = off[np.ix_(order, order)], turned[np.ix_(order, order)]
        norm = lambda m: np.sqrt((m * m).sum())
        wrong = norm(turned - np.diag(values)) + norm(off) * np.abs(values).max()
        if wrong <= least or before / 2 <= wrong <= 256 * least:
            break
        before = wrong
        # Closer than this, the iteration cannot tell two values apart.
        near = APART * wrong
        gaps = values[None, :] - values[:, None]
        close = np.abs(gaps) <= near
        step = np.where(close, off / 2, (turned + values[None, :] * off) / np.where(close, 1, gaps))
        vectors = vectors + vectors @ step
        for cluster in _clusters(values, near):
            part = vectors[:, cluster]
            centre = values[cluster].mean()
            # Shifted to the cluster, the differences inside it keep their digits; its scale is taken out of the solve.
            own = part.T @ (high @ part) - centre * (part.T @ part)
            size_of = np.abs(own).max()
            if size_of:
                turn = np.linalg.eigh(((own + own.T) / (2 * size_of)).astype(np.float64))[1].astype(np.longdouble)
                # One step makes the rotation orthogonal to the higher precision.
                vectors[:, cluster] = part @ (turn + turn @ (np.eye(len(cluster)) - turn.T @ turn) / 2)
    values, vectors = values[::-1] * scale, vectors[:, ::-1]
    return values, vectors / np.sqrt((vectors * vectors).sum(axis=0))


# --- whole numbers ----------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its entries are finite numbers."""
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda e: F.floor(e.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def _packed(vector: Column) -> Column:
    @F.arrow_udf("binary")
    def made(lists: pa.Array) -> pa.Array:
        return pa.array([np.asarray(x.values, "<i8").tobytes() for x in lists], pa.binary())

    return made(vector)


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def _added(rows: DataFrame, terms: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, object]:
    """Sums over all packed vectors ``x`` of the array that ``terms`` gives for a block, by flat position."""
    exact = kind.startswith("decimal")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = terms(_rows(batch.column("x").slice(at, BLOCK))).ravel()
                part = part.astype(object) if exact else part
                total = part if total is None else total + part
        if total is not None:
            for at in range(0, len(total), 1 << 16):
                some = total[at : at + (1 << 16)]
                values = pa.array([str(int(v)) for v in some], pa.string()) if exact else pa.array(some, pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(some))), values], names=["at", "v"])

    found = rows.select("x").mapInArrow(sums, f"at long, v {'string' if exact else 'double'}")
    added = found.groupBy("at").agg(F.sum(F.col("v").cast(kind)).alias("v"))
    return {r["at"]: r["v"] for r in added.collect()}


def _products(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Products of centred entries, added up over the rows, exactly: in floats where no sum can be rounded."""
    z = x - centre
    most = int(np.abs(z).max(initial=0))
    if most * most * len(z) < 1 << 53:
        z = z.astype(np.float64)
        return (z.T @ z).astype(np.int64)
    z = z.astype(object)
    return z.T @ z


class Fit:
    """What whitening needs of the fit list: size, sums, components, their variances and shares."""

    def __init__(self, vectors: DataFrame, components: int) -> None:
        self.n = vectors.count()
        sums = _added(vectors, lambda x: x.astype(object).sum(axis=0) if np.abs(x).max(initial=0) > 1 << 40 else x.sum(axis=0), "decimal(38,0)")
        self.sums = [int(sums[d]) for d in sorted(sums)]
        size, n = len(self.sums), self.n
        self.components = np.zeros((size, 0))
        self.variances = self.shares = np.zeros(0)
        if not n or not size:
            return
        middle = [(2 * s + n) // (2 * n) for s in self.sums]
        centre = np.array(middle, np.int64)
        products = _added(vectors, lambda x: _products(x, centre), "decimal(38,0)")
        left = [s - n * m for s, m in zip(self.sums, middle, strict=True)]
        # n * n times the covariance, in whole numbers.
        exact = [[n * int(products[i * size + j]) - left[i] * left[j] for j in range(size)] for i in range(size)]
        covariance = np.array([[_long_double(v, n * n) for v in row] for row in exact], np.longdouble)
        values, axes = refined(covariance)
        trace = _long_double(sum(exact[i][i] for i in range(size)), n * n)
        real = values > np.finfo(np.float64).eps * size * trace
        kept = np.flatnonzero(real)[:components]
        self.components = axes[:, kept].astype(np.float64)
        self.variances = values[kept].astype(np.float64)
        self.shares = (values[kept] / trace).astype(np.float64) if trace else values[kept].astype(np.float64)

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``n * x - S`` in whole numbers, and ``x - S / n``."""
        n, sums = self.n, self.sums
        bound = max(abs(s) for s in sums) + n * int(np.abs(x).max(initial=0))
        away = n * x - np.array(sums, np.int64) if bound < 1 << 62 else n * x.astype(object) - np.array(sums, object)
        return away, away.astype(np.float64) / n

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.components / np.sqrt(self.variances)


def _long_double(value: int, by: int) -> np.longdouble:
    """A ratio of whole numbers as a long double: leading part and rest."""
    whole_part = Fraction(value, by)
    first = float(whole_part)
    return np.longdouble(first) + np.longdouble(float(whole_part - Fraction(first)))


def _identity_error(vectors: DataFrame, fit: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    size = len(fit.variances)
    if not size:
        return 0.0
    means = _added(vectors, lambda x: fit.whitened(fit.centred(x)[1]).sum(axis=0), "double")
    mean = np.array([means[i] for i in range(size)]) / fit.n

    def products(x: np.ndarray) -> np.ndarray:
        w = fit.whitened(fit.centred(x)[1]) - mean
        return w.T @ w

    found = _added(vectors, products, "double")
    covariance = np.array([found[i] for i in range(size * size)]).reshape(size, size) / fit.n
    return float(np.abs(covariance - np.eye(size)).max())


def _deviation(away: np.ndarray) -> np.ndarray:
    """Sums of squares in whole numbers; beyond the long range an error."""
    most = int(np.abs(away).max(initial=0))
    if away.shape[1] * most * most < 1 << 63:
        return (away * away).sum(axis=1).astype(np.int64)
    return np.array([sum(int(v) * int(v) for v in row) for row in away], object)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for ``rows`` (``vec_id, embedding``)."""
    kept = rows.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long"), _packed(whole(F.col("embedding"))).alias("x"))
    vectors = written(kept.select("x").distinct(), "vectors")
    lengths = [r[0] // 8 for r in vectors.select(F.octet_length("x")).distinct().limit(2).collect()]
    if len(lengths) > 1:
        raise ValueError(f"vectors of {sorted(lengths)} entries have no common covariance")
    fit = Fit(vectors, components)
    error = _identity_error(vectors, fit)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(fit.variances)
        for batch in batches:
            for at in range(0, batch.num_rows if size else 0, BLOCK):
                piece = batch.slice(at, BLOCK)
                away, centred = fit.centred(_rows(piece.column("x")))
                count = len(away)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("vec_id").take(pa.array(np.repeat(np.arange(count), size))),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * size, fit.n, np.int64)),
                        pa.array(np.repeat(_deviation(away), size), pa.int64()),
                        pa.array(fit.whitened(centred).ravel()),
                        pa.array(np.tile(fit.shares, count)),
                        pa.array(np.full(count * size, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return kept.mapInArrow(made, schema)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"))
