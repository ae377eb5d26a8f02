from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrix(values: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A symmetric matrix with these eigenvalues, and its eigenvectors, in long doubles."""
    size = len(values)
    axes = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0].astype(np.longdouble)
    for _ in range(3):
        axes = axes + axes @ (np.eye(size) - axes.T @ axes) / 2
    made = (axes * np.asarray(values, np.longdouble)) @ axes.T
    return (made + made.T) / 2, axes


SPECTRA = {
    "spread": np.linspace(1, 90, 64),
    "equal": np.ones(20),
    "clustered": np.concatenate([3 + 1e-9 * np.arange(5), [1, 1 + 1e-5, 1 + 1e-7, 2, 2 + 1e-11], np.linspace(4, 9, 30)]),
    "nearly equal": np.concatenate([1 + 1e-13 * np.arange(6), [2, 3, 1e-8, 1e-12]]),
    "singular": np.concatenate([np.zeros(5), np.linspace(1, 2, 10)]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_eigenvectors_are_right_beyond_double_precision(name):
    values = SPECTRA[name]
    made, axes = matrix(values)
    found, vectors = whitening.refined(made)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-17
    assert np.abs(made @ vectors - vectors * found).max() < 1e-16
    assert (np.diff(found) <= 0).all() and np.abs(found - np.sort(values)[::-1]).max() < 1e-16
    if name in ("spread", "clustered"):
        order = np.argsort(-values)
        assert np.abs(1 - np.abs((axes[:, order] * vectors).sum(axis=0))).max() < 1e-15


def rows(size: int, count: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((count, size)) @ rng.standard_normal((size, size)) + 3
    return [(i, [float(np.float32(v)) for v in row], 0) for i, row in enumerate(mixed)]


def whole(vector: list[float]) -> tuple[int, ...]:
    return tuple(math.floor(64 * float(np.float32(v))) + 1_000_000 for v in vector)


def check(spark, table: list[tuple], frame=None) -> list:
    """Compare with plain Python: exact whole numbers, and a textbook eigendecomposition in doubles."""
    usable = [(i, whole(v)) for i, v, _ in table if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fit = np.array(sorted({x for _, x in usable}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums).astype(float) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    size = min(16, int((values > 1e-9 * values.max()).sum()))
    found = whitening.whiten(frame or spark.createDataFrame(table, SCHEMA).repartition(3)).collect()
    assert len(found) == len(usable) * size
    by_row: dict = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
        assert r.n == n and r.identity_error < 1e-12
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    signs = None
    for i, x in usable:
        away = n * np.array(x, object) - sums
        got = by_row[(i, int((away * away).sum()))]
        want = (away.astype(float) / n) @ axes[:, :size] / np.sqrt(values[:size])
        mine = np.array([got[c] for c in range(1, size + 1)])
        if signs is None:
            signs = np.where(np.abs(mine) > 1e-3, np.sign(mine * want), 0)
        assert all(abs(m - s * w) < 1e-7 for m, s, w in zip(mine, signs, want, strict=True) if s)
    return found


def test_whitening_equals_plain_python(spark):
    table = rows(24, 400, 1)
    table += [(1_000 + i, table[5][1], 1) for i in range(150)] + [(7, table[7][1], 0), (None, table[9][1], None)]
    table += [(2_000, None, 0), (2_001, [*table[0][1][:-1], None], 0), (2_002, [*table[0][1][:-1], math.nan], 0)]
    table += [(2_003, [*table[0][1][:-1], math.inf], 0), (2_004, [*table[0][1][:-1], -math.inf], 0)]
    found = check(spark, table)
    assert {r.vec_id for r in found} == {i for i, *_ in table if i is None or i < 2_000}
    clashing = spark.createDataFrame(table, SCHEMA).withColumns({"x": F.lit(1), "n": F.lit(1), "at": F.lit(2)})
    assert len(whitening.whiten(clashing).collect()) == len(found)


def test_fewer_components_than_asked_for(spark):
    check(spark, rows(3, 50, 2))
    flat = [(i, [1.0, float(i % 7), 2.0 * (i % 7), float(i % 3)], 0) for i in range(60)]
    assert {r.component for r in check(spark, flat)} == {1, 2}


def test_far_entries_and_centres_stay_exact(spark):
    rng = random.Random(4)
    check(spark, [(i, [float(rng.randrange(-(10**5), 10**5)) for _ in range(5)], 0) for i in range(80)])
    x = np.array([[10**12, 3], [-(10**12), 4]])
    assert whitening._products(x, np.array([0, 3])).tolist() == [[2 * 10**24, -(10**12)], [-(10**12), 1]]


def test_small_tables_and_errors(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert whitening.whiten(spark.createDataFrame([(1, None, 0), (2, [None], 0)], SCHEMA)).isEmpty()
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], SCHEMA)
    assert whitening.whiten(same).isEmpty()
    with pytest.raises(ValueError, match="no common covariance"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], SCHEMA))
