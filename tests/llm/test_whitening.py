"""Eigenvectors and whitened rows against dense linear algebra on the driver."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int, x string, component double, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1.5, "w") for i, v in rows], SCHEMA)


def dense(rows, components=4, scale=256):
    """Per row and component (id, component, n, deviation, whitened), eigenvalues and the trace."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(scale * c) for c in v] for _, v in kept], dtype=object)
    distinct = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct.astype(float) - sums.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    trace = values.sum()
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    keep = values > 1e-12 * trace
    values, vectors = values[keep], vectors[:, keep]
    white = (x.astype(float) - sums.astype(float) / n) @ vectors / np.sqrt(values)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return [i for i, _ in kept], n, deviation, white, values, trace


def random_rows(seed, count, dims, spread):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    return [(i, list(map(float, v))) for i, v in enumerate(rng.standard_normal((count, dims)) * spread @ turn)]


CASES = {
    "plain": random_rows(1, 300, 10, np.linspace(5, 1, 10)),
    "repeated": random_rows(2, 60, 8, np.linspace(5, 1, 8)) * 3 + [(None, [1.0] * 8)] * 200,
    "two dimensions": random_rows(3, 50, 2, np.array([3, 1])),
    "one dimension": [(i, [float(i % 7)]) for i in range(30)],
    "flat": [(i, [float(i % 5), 2.0 * (i % 5), 7.0, 7.0]) for i in range(20)],
    "steep": random_rows(4, 400, 12, 10.0 ** -np.arange(12) * 1e6),
    "wide": random_rows(5, 300, 140, np.linspace(9, 1, 140)),
}


@pytest.mark.parametrize("name", CASES)
def test_equals_dense_algebra(spark, name):
    rows = CASES[name]
    found, distinct, fit = whitening.whiten(table(spark, rows))
    ids, n, deviation, white, values, trace = dense(rows)
    assert fit.rows == n and np.allclose(fit.values, values, rtol=1e-9) and math.isclose(fit.trace, trace, rel_tol=1e-12)
    got = {}
    for r in found.collect():
        got.setdefault((r.vec_id, int(r.deviation)), []).append((r.component, r.whitened))
    assert sum(map(len, got.values())) == len(ids) * len(values)
    expected = {(i, d): w for i, d, w in zip(ids, deviation, white)}
    assert got.keys() == expected.keys()
    rows_found = np.array([[w for _, w in sorted(set(got[k]))] for k in expected])
    signs = np.sign((rows_found * np.array(list(expected.values()))).sum(axis=0))
    assert np.abs(rows_found * signs - np.array(list(expected.values()))).max() < 1e-7
    assert whitening.identity_error(distinct, fit) < 1e-9


def test_tied_eigenvalues(spark):
    """A cube's corners vary alike in all directions: any basis will do, but it must be one."""
    rows = [(i, [float(i >> b & 1) for b in range(6)]) for i in range(64)]
    _, distinct, fit = whitening.whiten(table(spark, rows))
    assert len(fit.values) == 4 and np.ptp(fit.values) < 1e-9 * fit.values[0]
    assert np.allclose(fit.vectors.T @ fit.vectors, np.eye(4), atol=1e-12)
    assert whitening.identity_error(distinct, fit) < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 2.0])], [(1, [3.0, 4.0])] * 5])
def test_nothing_to_fit(spark, rows):
    found, _, fit = whitening.whiten(table(spark, rows))
    assert fit is None and found.collect() == [] and found.columns == ["vec_id", "component", "deviation", "whitened"]


def test_awkward_rows_are_left_out(spark):
    rows = CASES["plain"] + [(900, None), (901, []), (902, [1.0] * 9), (903, [None] * 10), (904, [float("inf")] * 10), (None, [0.5] * 10)]
    found, _, fit = whitening.whiten(table(spark, rows))
    assert found.where("vec_id >= 900").isEmpty() and fit.rows == 301
    assert found.where("vec_id IS NULL").count() == 4


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = [(i, [float(2**30 * (i % 4)), float(i)]) for i in range(400)]
    found, _, _ = whitening.whiten(table(spark, rows))
    _, _, deviation, *_ = dense(rows)
    assert {int(r.deviation) for r in found.collect()} == set(deviation) and max(deviation) > 2**63


def test_inertia():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 8, 33):
        for k in range(30):
            a = rng.standard_normal((n, n)).round(k % 3)
            a += a.T
            values = np.linalg.eigvalsh(a)
            if np.abs(values).min() > 1e-9:
                assert whitening.inertia(a) == (values > 0).sum()
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
    assert whitening.inertia(np.zeros((3, 3))) == 0


def test_a_missed_eigenvalue_raises(spark, monkeypatch):
    monkeypatch.setattr(whitening._Solver, "above", lambda self, shifts: [5 if s < 1 else 0 for s in shifts])
    with pytest.raises(ArithmeticError):
        whitening.largest(spark, np.diag([9.0, 8.0, 7.0, 6.0, 0.1, 0.1]), whitening.Whitening())


def test_hot_vector(spark):
    draw = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda c: F.pmod(F.xxhash64("id", c), F.lit(1000)) / 100 * c)
    hot = F.when(F.col("id") % 3 == 0, F.transform(draw, lambda c: F.lit(1.0))).otherwise(draw)
    docs = spark.range(1200).select(F.col("id").alias("vec_id"), hot.alias("embedding"))
    _, _, fit = whitening.whiten(docs)
    _, n, _, _, values, _ = dense([(r.vec_id, r.embedding) for r in docs.collect()])
    assert fit.rows == n == 801 and np.allclose(fit.values, values, rtol=1e-9)


def test_eigenvalues_close_below_the_wanted_ones(spark):
    """One variance far above the others, which lie close together: few vectors alone never tell them apart."""
    values = np.r_[0.44, 0.145, 0.0744, 0.07425, 0.0722 - 2.5e-4 * np.arange(60)]
    turn = np.linalg.qr(np.random.default_rng(3).standard_normal((64, 64)))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.largest(spark, matrix, whitening.Whitening())
    assert np.abs(found - values[:4]).max() < 1e-14
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-14
