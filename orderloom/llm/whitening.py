"""Whitening of integer vectors by contour-integral eigenvectors of their covariance (FEAST).

1. Components times the scale, rounded down, are written as ``x``; the fit list has each distinct
   ``x`` once. Its sums per component, and its covariance centred before multiplying, are partial
   sums of tasks: one row per task and component, added up on Spark.
2. Inertia counts (signs of a symmetric factorisation of the shifted covariance) find an interval
   that holds the largest eigenvalues and keeps its ends away from any. Shifts are tried in rows of
   a Spark job, and so are the points of the contour around the interval: each solves the complex
   shifted system, and the weighted sum of the solutions projects onto the wanted eigenvectors.
   Rayleigh-Ritz on the projected basis extracts them. This repeats until the residuals are at
   rounding level, with twice as many vectors (at most one per component) after a round that gains
   little, as where eigenvalues lie close below the interval; in the end the number of eigenvalues found must equal the inertia count.
3. Every row is projected in tasks. The whitened fit list's covariance is measured the same way.

The covariance has as many rows as vectors have components (at most ``Whitening.most_dims``),
whatever the table holds; it is the one thing that goes to the driver and to all tasks.

Defined cases: rows whose vector is null or empty or holds a null or a component that is no finite
number are left out; where vectors differ in length, the commonest length counts (the longer of
two) and the others are left out; null and repeated ids stay, repeated vectors count once in the
fit. Components without variance (an eigenvalue below 1e-12 of the trace) are not returned, so a
table of one distinct vector, like an empty one, gives no rows. A component beyond 2**40 raises.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize

# A component this large, times the rows of any fit list, still fits the sums.
_MOST = float(2**40)


@dataclass(frozen=True)
class Whitening:
    components: int = 4
    scale: int = 256
    most_dims: int = 2048
    points: int = 8  # of the contour's upper half
    extra: int = 6  # basis vectors beyond the wanted ones
    most_rounds: int = 30


@dataclass(frozen=True)
class Fit:
    rows: int
    sums: list[int]  # of x, per component
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # one column each

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.rows for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def integer_vectors(table: DataFrame, how: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key`` and ``x`` of the rows with finite components only, of all lengths."""

    def whole(c: Column) -> Column:
        scaled = c.cast("double") * F.lit(float(how.scale))
        beyond = F.raise_error(F.lit("a component is too large to be a whole number of 64 bits"))
        return F.when(F.abs(scaled) < _MOST, F.floor(scaled)).otherwise(beyond.cast("bigint"))

    named = table.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").alias("v"))
    finite = F.forall("v", lambda c: F.abs(c.cast("double")) < F.lit(float("inf")))
    return named.where((F.size("v") > 0) & finite).select(key, F.transform("v", whole).alias("x"))


def _of_one_length(vectors: DataFrame, how: Whitening) -> tuple[DataFrame, int]:
    lengths = vectors.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("rows"))
    first = lengths.orderBy(F.col("rows").desc(), F.col("dims").desc()).first()
    dims = first.dims if first else 0
    if dims > how.most_dims:
        raise ValueError(f"vectors of {dims} components; the covariance is held whole up to {how.most_dims}")
    return vectors.where(F.size("x") == dims), dims


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _slices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Pieces of some million numbers, so that copies of wide vectors stay small."""
    step = max(1, (1 << 20) // dims)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _summed(vectors: DataFrame, dims: int, columns: int, term: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of the matrix ``term`` over all pieces of ``vectors``, as ``columns`` columns."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _slices(batches, dims):
            part = term(_matrix(batch, dims))
            total = part if total is None else total + part
        if total is not None:
            rows = pa.array(range(len(total)), pa.int32())
            flat = pa.ListArray.from_arrays(np.arange(0, total.size + 1, columns, dtype=np.int32), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([rows, flat], ["i", "part"])

    parts = vectors.mapInArrow(summed, "i int, part array<double>")
    return _collected(parts, columns)


def _collected(parts: DataFrame, columns: int) -> np.ndarray:
    """The matrix whose rows ``i`` are the sums of ``part``."""
    if columns <= 128:
        sums = parts.groupBy("i").agg(*[F.expr(f"sum(part[{c}]) AS s{c}") for c in range(columns)])
        return np.array([row[1:] for row in sorted(sums.collect())])
    # Wide rows are added up by place, not by a column for each.
    places = parts.select("i", F.posexplode("part").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = places.toArrow()
    rows, at = found.column("i").to_numpy(), found.column("j").to_numpy()
    out = np.zeros((rows.max() + 1, columns))
    out[rows, at] = found.column("v").to_numpy()
    return out


def covariance(vectors: DataFrame, rows: int, mean: np.ndarray, projection: np.ndarray | None = None) -> np.ndarray:
    """Of ``x``, or of its projection; centred before multiplying, divisor ``rows``."""
    dims, middle = len(mean), 0.0
    width = dims if projection is None else projection.shape[1]

    def centred(x: np.ndarray) -> np.ndarray:
        return x - mean if projection is None else (x - mean) @ projection

    def products(x: np.ndarray) -> np.ndarray:
        y = centred(x) - middle
        return y.T @ y

    if projection is not None:
        middle = _summed(vectors, dims, width, lambda x: centred(x).sum(axis=0, keepdims=True))[0] / rows
    found = _summed(vectors, dims, width, products) / rows
    return (found + found.T) / 2


def inertia(matrix: np.ndarray) -> int:
    """The number of positive eigenvalues, by a symmetric factorisation with 1x1 and 2x2 pivots (Bunch-Kaufman)."""
    a, positive, alpha = matrix.copy(), 0, (1 + 17**0.5) / 8
    while (n := len(a)) > 0:
        below = np.abs(a[1:, 0])
        r = int(below.argmax()) + 1 if n > 1 else 0
        most = below[r - 1] if n > 1 else 0.0
        swap, size = 0, 1
        if most > 0 and abs(a[0, 0]) < alpha * most:
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() >= alpha * most * most:
                pass
            elif abs(a[r, r]) >= alpha * row.max():
                swap = r
            else:
                swap, size = r, 2
        if swap:
            order = np.arange(n)
            order[[size - 1, swap]] = order[[swap, size - 1]]
            a = a[np.ix_(order, order)]
        if size == 1:
            pivot = a[0, 0]
            positive += pivot > 0
            a = a[1:, 1:] - (np.outer(a[1:, 0], a[0, 1:] / pivot) if pivot else 0.0)
        else:  # such a block has one eigenvalue of either sign
            positive += 1
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return int(positive)


class _Solver:
    """The covariance on all workers, and jobs over shifts and contour points."""

    def __init__(self, spark: SparkSession, matrix: np.ndarray):
        self.spark, self.n = spark, len(matrix)
        self.sent = spark.sparkContext.broadcast(matrix)

    def close(self) -> None:
        self.sent.destroy()

    def above(self, shifts: list[float]) -> list[int]:
        """How many eigenvalues lie above each shift."""
        sent = self.sent

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                shifts = batch.column("shift").to_pylist()
                found = [inertia(sent.value - s * np.eye(len(sent.value))) for s in shifts]
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(found, pa.int32())], ["k", "n"])

        rows = self.spark.createDataFrame(list(enumerate(shifts)), "k int, shift double")
        found = rows.repartition(min(len(shifts), 16), "k").mapInArrow(count, "k int, n int").collect()
        return [row.n for row in sorted(found)]

    def project(self, centre: float, radius: float, basis: np.ndarray, points: int) -> np.ndarray:
        """The contour integral of the resolvent around the interval, applied to ``basis``."""
        sent, shape = self.sent, basis.shape
        columns = self.spark.sparkContext.broadcast(basis)
        nodes, weights = np.polynomial.legendre.leggauss(points)
        angles = np.pi / 2 * (nodes + 1)

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for angle, weight in zip(batch.column("angle").to_pylist(), batch.column("weight").to_pylist()):
                    turn = np.exp(1j * angle)
                    shifted = (centre + radius * turn) * np.eye(shape[0]) - sent.value
                    part = (weight / 2 * radius * turn * np.linalg.solve(shifted, columns.value)).real
                    offsets = np.arange(0, part.size + 1, shape[1], dtype=np.int32)
                    flat = pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), flat], ["i", "part"])

        rows = self.spark.createDataFrame([(float(a), float(w)) for a, w in zip(angles, weights)], "angle double, weight double")
        parts = rows.repartition(points, "angle").mapInArrow(solve, "i int, part array<double>")
        found = _collected(parts, shape[1])
        columns.destroy()
        return found


def _brackets(solver: _Solver, top: float, most: int) -> np.ndarray:
    """Lower and upper ends, a millionth of ``top`` apart, for each of the ``most`` largest eigenvalues."""
    ends = np.tile([-0.001 * top, 1.001 * top], (most, 1))
    for _ in range(10):
        tried = ends[:, :1] + (ends[:, 1:] - ends[:, :1]) * np.array([0.25, 0.5, 0.75])
        counts = np.array(solver.above(tried.ravel().tolist())).reshape(most, 3)
        for k in range(most):
            inside = counts[k] > k  # the eigenvalue lies above these shifts
            ends[k] = max([ends[k, 0], *tried[k, inside]]), min([ends[k, 1], *tried[k, ~inside]])
    return ends


def _interval(solver: _Solver, top: float, how: Whitening) -> tuple[float, float]:
    """An interval with all wanted eigenvalues, ending below them in the widest of the next gaps.

    Where the next eigenvalues cannot be told apart, the interval holds all eigenvalues.
    """
    known = min(solver.n, how.components + how.extra + 1)
    ends = _brackets(solver, top, known)
    gaps = {m: ends[m - 1, 0] - ends[m, 1] for m in range(how.components, known)}
    best = max(gaps, key=gaps.get, default=None)
    if best is None or gaps[best] < 1e-5 * top:
        low = -0.1 * top
    else:
        low = (ends[best - 1, 0] + ends[best, 1]) / 2
    return float(low), float(ends[0, 1] + 0.1 * (ends[0, 1] - low))


def largest(spark: SparkSession, matrix: np.ndarray, how: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors as columns.

    Signs are such that the largest entry of a vector is positive. Raises if residuals do not
    fall to rounding level, or if inertia counts say that an eigenvalue is missing.
    """
    top, n = float(np.abs(matrix).sum(axis=1).max()), len(matrix)
    solver = _Solver(spark, matrix)
    try:
        low, high = _interval(solver, top, how)
        above, beyond = solver.above([low, high])
        held = above - beyond
        draw = np.random.default_rng(0).standard_normal
        basis = draw((n, min(n, held + how.extra)))
        before, slow = np.inf, False
        for _ in range(how.most_rounds):
            basis = np.linalg.qr(solver.project((low + high) / 2, (high - low) / 2, basis, how.points))[0]
            values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
            basis, inside = basis @ turns, values > low
            left = np.abs(matrix @ basis - basis * values)[:, inside].max(initial=0.0) / top
            slow, stalled = left > before / 16, slow
            if left < 1e-15 or (left < 1e-11 and slow and (stalled or basis.shape[1] == n)):
                break
            before = left
            if slow:  # eigenvalues close below the interval: more vectors take them in, all of them in the end
                basis = np.hstack([basis, draw((n, min(n, 2 * basis.shape[1]) - basis.shape[1]))])
        else:
            raise ArithmeticError(f"residuals stay at {left:.1e} of the largest eigenvalue")
        if inside.sum() != held:
            raise ArithmeticError(f"{inside.sum()} eigenvalues found, {held} counted")
    finally:
        solver.close()
    order = np.flatnonzero(inside)[::-1][: how.components]
    values, vectors = values[order], basis[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(order))])
    return values, vectors * signs / np.linalg.norm(vectors, axis=0)


def _exact_sums(distinct: DataFrame, dims: int) -> list[int]:
    """The sum of each component over the fit list, exactly."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for batch in _slices(batches, dims):
            total += _matrix(batch, dims).sum(axis=0).astype(object)
        parts = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), parts], ["i", "part"])

    parts = distinct.mapInArrow(summed, "i int, part decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("part").alias("total")).orderBy("i").collect()
    return [int(row.total) for row in rows]


def fit(distinct: DataFrame, dims: int, how: Whitening) -> Fit | None:
    """Components of the fit list; None without rows or variance."""
    rows = distinct.count()
    if not rows:
        return None
    sums = _exact_sums(distinct, dims)
    matrix = covariance(distinct, rows, np.array([s / rows for s in sums]))
    trace = float(np.trace(matrix))
    if trace <= 0:
        return None
    values, vectors = largest(distinct.sparkSession, matrix, how)
    varied = values > 1e-12 * trace
    return Fit(rows, sums, trace, values[varied], vectors[:, varied])


def _deviations(x: np.ndarray, found: Fit) -> pa.Array:
    """The sum over components of (rows * x - sums) squared, exactly; null from 10**38 on."""
    reach = found.rows * int(np.abs(x).max(initial=0)) + max(map(abs, found.sums))
    if x.shape[1] * reach * reach < 2**62:
        away = found.rows * x - np.array(found.sums, np.int64)
        return pa.array((away * away).sum(axis=1)).cast(pa.decimal128(38, 0))
    away = found.rows * x.astype(object) - np.array(found.sums, object)
    exact = (away * away).sum(axis=1)
    return pa.array([Decimal(int(e)) if e < 10**38 else None for e in exact], pa.decimal128(38, 0))


def project(vectors: DataFrame, found: Fit, key: str = "vec_id") -> DataFrame:
    """``key, component, deviation, whitened``: a row for each row of ``vectors`` and component."""
    dims, width = len(found.sums), len(found.values)
    mean, projection = found.mean, found.projection
    kind = vectors.schema[key].dataType.simpleString()

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, dims):
            x = _matrix(batch, dims)
            # Sums by row, unlike a matrix product, give equal rows equal results to the last bit.
            flat = np.stack([((x - mean) * p).sum(axis=1) for p in projection.T], axis=1).ravel()
            again = pa.array(np.repeat(np.arange(len(x)), width))
            numbers = pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x)))
            columns = [batch.column(key).take(again), numbers, _deviations(x, found).take(again), pa.array(flat)]
            yield pa.RecordBatch.from_arrays(columns, [key, "component", "deviation", "whitened"])

    schema = f"`{key}` {kind}, component int, deviation decimal(38,0), whitened double"
    return vectors.select(key, "x").mapInArrow(whitened, schema)


def identity_error(distinct: DataFrame, found: Fit) -> float:
    """The largest entry by which the whitened fit list's covariance differs from the identity."""
    measured = covariance(distinct, found.rows, found.mean, found.projection)
    return float(np.abs(measured - np.eye(len(measured))).max())


def whiten(
    table: DataFrame, how: Whitening = Whitening(), key: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, DataFrame, Fit | None]:
    """Projected rows (as ``project``), the fit list and what was fitted."""
    vectors, dims = _of_one_length(materialize(integer_vectors(table, how, key, vector), "vectors"), how)
    distinct = materialize(vectors.select("x").distinct(), "fit-list")
    found = fit(distinct, dims, how)
    if found is None:
        kind = vectors.schema[key].dataType.simpleString()
        schema = f"`{key}` {kind}, component int, deviation decimal(38,0), whitened double"
        return table.sparkSession.createDataFrame([], schema), distinct, None
    return project(vectors, found, key), distinct, found
