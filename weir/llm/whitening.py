"""Whitening of embeddings, with eigenvectors refined from single to double precision.

1. *Fit list.*  Entries become whole numbers ``x = floor(256 * c)``; equal
   vectors count once (collapsed before the shuffle) and are written.
2. *Covariance.*  One pass for the number n and the exact sums S, one for the
   products of vectors centred on S / n.  Each task sends one matrix, row by
   row, and rows are added on Spark; the driver sees the d x d sum.
3. *Eigenvectors.*  A float32 eigensolver gives first vectors.  Ogita-Aishima
   iterations, matrix products in higher precision, correct all of them at
   once with quadratic convergence.  Eigenvalues closer than the current error
   form clusters: only the span of a cluster converges by that, so the matrix
   is projected on the span, shifted by the cluster's mean, and solved there,
   which makes the differences visible again.
4. *Rows.*  Every row is centred, projected and scaled in its task; a last pass
   over the fit list measures the covariance of what came out.

What the driver holds, and tasks get, is d x d numbers for vectors of length d,
whatever the number of rows.

Defined cases: rows whose vector is null, or holds null or non-finite entries,
are dropped, rows without an id are not; entries beyond the range of a long
become its ends; of vectors of several lengths the commonest is whitened (ties:
the longest) and the others are dropped; components without variance can't be
whitened and are left out, so equal vectors, or a single one, give no rows; a
deviation beyond a long is null; an empty table, or vectors without entries,
give no rows; repeated rows are rows each; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import written

#: Entries are multiplied by this and rounded down.
SCALE = 256
#: Corrections at most until the spans of all clusters stand (three to five do), and sub-solves of clusters.
ROUNDS, SOLVES = 20, 12
#: Values are taken for a cluster when nearer than this many times the error.
APART = 8
#: What "higher precision" is: 64-bit mantissa where the machine has it, else double.
HIGH = np.longdouble

Batches = Iterator[pa.RecordBatch]
Matrix = np.ndarray
_LOW, _TOP = -(2 ** 63), 2 ** 63 - 1


class Fit(NamedTuple):
    """What whitening needs: size of the fit list, exact sums, eigenvectors (columns, falling), eigenvalues, trace."""

    n: int
    sums: list[int]
    vectors: Matrix
    values: Matrix
    trace: float
    error: float = math.nan

    @property
    def mean(self) -> Matrix:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


# --- eigenvectors ------------------------------------------------------------------------

def _clusters(values: Matrix, gap: float) -> Matrix:
    """The number of the run each value is in: values with neighbours no further apart than ``gap`` are a run."""
    order = np.argsort(values, kind="stable")
    run = np.empty(len(values), int)
    run[order] = np.concatenate([[0], np.cumsum(np.diff(values[order]) > gap)])
    return run


def _step(a: Matrix, x: Matrix) -> tuple[Matrix, Matrix, Matrix, float]:
    """One Ogita-Aishima correction of all vectors: (vectors, values, clusters, size of the correction)."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    norm = float(np.abs(values).max())
    off = (s - np.diag(values)).astype(float)
    error = float(np.linalg.norm(off, 2)) + norm * float(np.linalg.norm(r.astype(float), 2))
    # below the rounding of the products nothing can be told apart
    run = _clusters(values.astype(float), max(APART * error, len(a) * norm * float(np.finfo(a.dtype).eps)))
    near = run[:, None] == run[None, :]
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, values[None, :] - values[:, None]))
    return x + x @ e, values, run, float(np.abs(e).max())


def _solved_inside(a: Matrix, x: Matrix, run: Matrix) -> Matrix:
    """``x`` with each cluster's span turned to the eigenvectors that the matrix has in it."""
    x = x.copy()
    for c in np.flatnonzero(np.bincount(run) > 1):
        span = x[:, run == c]
        inner = span.T @ (a @ span)
        shift = np.trace(inner) / len(inner)
        inner = (inner - shift * (span.T @ span)).astype(float)
        _, turn = np.linalg.eigh((inner + inner.T) / 2)
        x[:, run == c] = span @ turn.astype(x.dtype)
    return x


def eigen(a: Matrix) -> tuple[Matrix, Matrix]:
    """(values, vectors as columns) of a symmetric matrix, falling, from a float32 solve refined to double precision."""
    scale = float(np.abs(a).max()) or 1.0
    scaled = (a / scale).astype(HIGH)
    _, first = np.linalg.eigh(scaled.astype(np.float32))
    x, tiny, solved = first.astype(HIGH), np.finfo(np.float64).eps / 4, None
    for _ in range(SOLVES):
        before = math.inf
        for _ in range(ROUNDS):
            x, _, run, change = _step(scaled, x)
            if change < tiny or change > before / 2:
                break
            before = change
        if run.max() + 1 == len(run) or (solved is not None and (run == solved).all()):
            break
        # the spans are as good as they get: what is inside them can be told apart once they are alone
        x, solved = _solved_inside(scaled, x, run), run
    eye = np.eye(len(a), dtype=HIGH)
    for _ in range(3):
        x = x + x @ (eye - x.T @ x) / 2
    values = (x * (scaled @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), x[:, order].astype(np.float64)


# --- tasks -----------------------------------------------------------------------------------

def _rows(column: pa.Array, d: int) -> Matrix:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _sums(d: int) -> Callable[[Batches], Batches]:
    """Exact sums of whole numbers: their high and low 32 bits apart, which a long adds up without overflow."""
    def run(batches: Batches) -> Batches:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _rows(batch.column("x"), d)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d)), pa.array([n] * d, pa.int64()), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])
    return run


def _products(d: int, mean: Matrix, turn: Matrix | None = None) -> Callable[[Batches], Batches]:
    """The task's sum of products of centred (and turned) vectors, and of the vectors, as rows of a matrix."""
    def run(batches: Batches) -> Batches:
        k = d if turn is None else turn.shape[1]
        total = np.zeros((k + 1, k))
        for batch in batches:
            y = _rows(batch.column("x"), d).astype(np.float64) - mean
            if turn is not None:
                y = y @ turn
            total[:k] += y.T @ y
            total[k] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k + 1), k)), pa.array(np.tile(np.arange(k), k + 1)), pa.array(total.ravel())], ["i", "j", "v"])
    return run


def _deviations(x: Matrix, n: int, sums: list[int]) -> list[int | None]:
    """sum of (n * x - S)^2, exactly; None beyond a long."""
    widest = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums))
    if len(sums) * widest * widest <= _TOP:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    found = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v <= _TOP else None for v in found]


def _whitened(d: int, fit: Fit) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        k = len(fit.values)
        turn, mean = fit.vectors / np.sqrt(fit.values), fit.mean
        for batch in batches:
            if not len(batch):
                continue
            x = _rows(batch.column("x"), d)
            w = (x.astype(np.float64) - mean) @ turn
            each = np.repeat(np.arange(len(x)), k)
            part = np.tile(fit.values / fit.trace, len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                 pa.array([fit.n] * len(each), pa.int64()), pa.array(_deviations(x, fit.n, fit.sums), pa.int64()).take(pa.array(each)),
                 pa.array(w.ravel()), pa.array(part), pa.array([fit.error] * len(each))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


# --- jobs ----------------------------------------------------------------------------------

def quantized(vector: Column) -> Column:
    """Whole numbers of a vector; beyond a long, its ends."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))  # floor to a long saturates


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that take part, and the length of their vectors."""
    rows = vectors.where(usable(F.col("embedding")) & (F.size("embedding") > 0))
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    x = quantized(F.col("embedding")).alias("x")
    return rows.where(F.size("embedding") == d).select(F.col("vec_id").cast("long").alias("vec_id"), x), d


def _matrix(listed: DataFrame, run: Callable[[Batches], Batches], k: int) -> tuple[Matrix, Matrix]:
    """(k x k sum of products, sums) over all tasks."""
    parts = listed.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((k + 1, k))
    for r in parts.collect():  # (k + 1) * k numbers
        total[r["i"], r["j"]] = r["v"]
    return total[:k], total[k]


def fit(rows: DataFrame, d: int, components: int | None = None) -> Fit | None:
    """The whitening of ``rows`` (x of length d); None without variance. All components, or the first few."""
    listed = written(rows.select("x").distinct(), "whitening-list")
    parts = (listed.mapInArrow(_sums(d), "i long, n long, high long, low long").groupBy("i")
             .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("i").collect())
    n = parts[0]["n"] if parts else 0
    if not n:
        return None
    sums = [(p["high"] << 32) + p["low"] for p in parts]
    plain = Fit(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    products, _ = _matrix(listed, _products(d, plain.mean), d)
    covariance = (products + products.T) / 2 / n
    values, vectors = eigen(covariance)
    trace = float(np.trace(covariance))
    real = values > max(values[0], 0.0) * d * np.finfo(np.float64).eps
    k = min(int(real.sum()), components or d)
    if not k:
        return None
    found = Fit(n, sums, vectors[:, :k], values[:k], trace)
    # how near the covariance of the result is to the identity, measured on the fit list
    second, first = _matrix(listed, _products(d, plain.mean, found.vectors / np.sqrt(found.values)), k)
    spread = second / n - np.outer(first / n, first / n)
    return found._replace(error=float(np.abs(spread - np.eye(k)).max()))


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that takes part."""
    rows, d = whole_vectors(vectors)
    found = fit(rows, d, components) if d else None
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None:
        return vectors.sparkSession.createDataFrame([], names)
    return rows.mapInArrow(_whitened(d, found), names)
