"""Whitening of embeddings: a distributed centred scatter and cyclic Jacobi rotations.

1. Tasks sum the quantised vectors; the sums are exact integers.
2. Tasks centre every vector by the exact mean, before anything is multiplied,
   and add up their products.  What a task hands on has the size of the
   covariance, whatever the table's.
3. The driver turns the covariance by symmetric Jacobi rotations, sweep after
   sweep over all pairs of dimensions, until every off-diagonal entry is
   negligible against its own two diagonal entries.  As that test is relative,
   small eigenvalues are as accurate as large ones.
4. The whitening matrix (dimensions x components) travels with the tasks that
   project the rows; the covariance of what they get is measured, not assumed.

The table is read once for each of these passes and nothing of it is shuffled
but those sums.  A table that is costly to compute should be written first.

Defined results: a vector that is null, empty, or holds null or non-finite
components is left out, and so is one of another length than the table's most
frequent one (of equally frequent lengths, the longest).  Rows that repeat count
as often as they occur, and a row without a key keeps its null key.  Components
without variance (all of them in a table of one row, or of equal rows) whiten to
0 and are not measured by ``identity_error``.  Entries beyond the range of a
long once scaled are held at its ends.  A deviation that is no long is null.  An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

#: Entry c of a vector is worked on as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors worked on at once.
ROWS_AT_ONCE = 4096
MAX_SWEEPS = 60
_LONG = 2.0**63

Batches = Iterator[pa.RecordBatch]


def jacobi_eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Cyclic Jacobi.  The sign of a vector makes its largest entry positive.
    """
    a = np.array(matrix, np.float64)
    n = len(a)
    v = np.eye(n)
    tiny = np.finfo(np.float64).tiny
    for _ in range(MAX_SWEEPS):
        turned = 0
        for p in range(n - 1):
            for q in range(p + 1, n):
                apq = a[p, q]
                if abs(apq) <= 1e-17 * np.sqrt(abs(a[p, p])) * np.sqrt(abs(a[q, q])) or abs(apq) < tiny:
                    continue
                turned += 1
                theta = (a[q, q] - a[p, p]) / (2 * apq)
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1 / np.hypot(t, 1.0)
                s = t * c
                app, aqq = a[p, p] - t * apq, a[q, q] + t * apq
                column_p, column_q = a[:, p].copy(), a[:, q]
                new_p, new_q = c * column_p - s * column_q, s * column_p + c * column_q
                a[:, p] = a[p, :] = new_p
                a[:, q] = a[q, :] = new_q
                a[p, p], a[q, q], a[p, q], a[q, p] = app, aqq, 0.0, 0.0
                vp = v[:, p].copy()
                v[:, p], v[:, q] = c * vp - s * v[:, q], s * vp + c * v[:, q]
        if not turned:
            break
    values = np.diag(a)
    order = np.argsort(-values, kind="stable")
    v = v[:, order]
    return values[order], v * np.where(v[np.abs(v).argmax(0), np.arange(n)] < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """What a fit found: count, exact sums, eigenvalues, whitening matrix and the measured error."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    trace: float
    matrix: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``, rounded once where n * x fits a long."""
        if len(x) and float(np.abs(x.astype(np.float64)).max()) * self.n < _LONG / 4 and max(map(abs, self.sums)) < _LONG / 4:
            return (x * np.int64(self.n) - np.array(self.sums, np.int64)) / self.n
        return x - np.array([s / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of ``(n * x - S) ** 2``, where a long holds it."""
        rough = float(self.n) ** 2 * (self.centred(x) ** 2).sum(1)
        if (rough < _LONG * 0.999).all():  # whole numbers modulo 2 ** 64, so what wraps on the way does no harm
            sums = np.array([s % 2**64 for s in self.sums], np.uint64)
            apart = x.view(np.uint64) * np.uint64(self.n) - sums
            return (apart * apart).sum(1).view(np.int64).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [d if d < 2**63 else None for d in exact]


def _quantised(column: pa.Array) -> np.ndarray:
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(SCALE * c)
    held = np.clip(scaled, -(2.0**62), 2.0**62).astype(np.int64) + SHIFT
    if (np.abs(scaled) > 2.0**62).any():
        for k in np.flatnonzero(np.abs(scaled) > 2.0**62).tolist():
            whole = int(scaled[k]) if np.isfinite(scaled[k]) else int(np.sign(scaled[k])) * 2**64
            held[k] = min(max(whole + SHIFT, -(2**63)), 2**63 - 1)
    return held.reshape(len(column), -1)


def _parts(batches: Batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield part, _quantised(part.column("embedding"))


def _sum_batches(batches: Batches) -> Batches:
    """Sums of the high and low halves of the entries, so that no sum leaves a long."""
    n, high, low = 0, np.int64(0), np.int64(0)
    for _, x in _parts(batches):
        n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
    if n:
        size = len(high)
        arrays = [pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, n)), pa.array(high), pa.array(low)]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "n", "high", "low"])


def _product_batches(values: Callable[[np.ndarray], np.ndarray]) -> Callable[[Batches], Batches]:
    """Sums (j = -1) and products of what ``values`` makes of the vectors."""

    def run(batches: Batches) -> Batches:
        n, total, products = 0, 0.0, 0.0
        for _, x in _parts(batches):
            y = values(x)
            n, total, products = n + len(y), total + y.sum(0), products + y.T @ y
        if n:
            i, j = np.triu_indices(len(total))
            i, j = np.append(np.arange(len(total)), i), np.append(np.full(len(total), -1), j)
            s = np.append(total, products[np.triu_indices(len(total))])
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(s)], names=["i", "j", "s"])

    return run


def _covariance(vectors: DataFrame, size: int, n: int, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Covariance (divisor n) of ``values``, which centre but for rounding; what is left of a mean is taken off."""
    parts = vectors.mapInArrow(lean(_product_batches(values)), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    mean, products = np.zeros(size), np.zeros((size, size))
    for i, j, s in parts.collect():  # a row for each pair of dimensions
        if j < 0:
            mean[i] = s / n
        else:
            products[i, j] = products[j, i] = s / n
    return products - np.outer(mean, mean)


def usable_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part, whatever else the table has."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c).cast("double") != F.lit(float("inf"))), F.lit(False)))
    rows = rows.where((F.size("embedding") > 0) & finite)
    usual = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (usual["d"] if usual else 0))


def fit_whitening(rows: DataFrame, components: int = 32) -> Whitening | None:
    """Whitening of the ``embedding`` column of ``usable_vectors``; None for an empty table."""
    vectors = rows.select("embedding")
    added = vectors.mapInArrow(lean(_sum_batches), "i int, n long, high long, low long")
    found = added.groupBy("i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("i").collect()
    if not found:
        return None
    fit = Whitening(found[0]["n"], [r["high"] * 2**32 + r["low"] for r in found], np.empty(0), 0.0, np.empty((0, 0)))
    size = len(found)
    covariance = _covariance(vectors, size, fit.n, fit.centred)
    values, basis = jacobi_eigen(covariance)
    kept = min(components, size)
    trace = float(np.trace(covariance))
    # What rounding leaves of a direction without variance is far below this.
    spread = values[:kept] > size * np.finfo(np.float64).eps * max(trace, np.finfo(np.float64).tiny)
    scale = np.where(spread, 1 / np.sqrt(np.where(spread, values[:kept], 1.0)), 0.0)
    fit = Whitening(fit.n, fit.sums, np.where(spread, values[:kept], 0.0), trace, basis[:, :kept] * scale)
    apart = np.abs(_covariance(vectors, kept, fit.n, lambda x: fit.centred(x) @ fit.matrix) - np.eye(kept))[np.ix_(spread, spread)]
    fit.identity_error = float(apart.max(initial=0.0))
    return fit


def _white_batches(fit: Whitening) -> Callable[[Batches], Batches]:
    size = len(fit.eigenvalues)
    explained = fit.eigenvalues / fit.trace if fit.trace > 0 else np.zeros(size)

    def run(batches: Batches) -> Batches:
        for batch, x in _parts(batches):
            y = fit.centred(x) @ fit.matrix
            rows = pa.array(np.repeat(np.arange(len(x)), size))
            deviation = pa.array(fit.deviations(x), pa.int64())
            arrays = [
                batch.column("vec_id").take(rows),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), fit.n)),
                deviation.take(rows),
                pa.array(y.ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows), fit.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, components: int = 32, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component."""
    rows = usable_vectors(vectors, key, embedding)
    fit = fit_whitening(rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None:
        return rows.select("vec_id").mapInArrow(lambda batches: iter(()), schema)
    return rows.mapInArrow(lean(_white_batches(fit)), schema)
