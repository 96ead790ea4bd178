"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors are rounded to whole numbers ``x = floor(64 * c) + 1000000`` per entry, and fitted on each distinct ``x``
once. Two passes over the distinct vectors give their number ``n`` and sums ``S`` (exact), and the scatter of
``x - S / n`` as one small matrix per task, added up in two further shuffled levels, so the driver gets a few
matrices of dimension squared, whatever the number of rows. There the pivoted Cholesky factor ``L`` (``P A P' = L L'``) is
rotated from the right until its columns are orthogonal (one-sided Jacobi, disjoint pairs at a time): the
columns' squared norms are the eigenvalues of the scatter and the normalised columns its eigenvectors. A last pass over the distinct vectors
measures the covariance of what the components make of them; a pass over all rows writes the result.

Defined results: vectors that are null, empty or hold a null or non-finite entry take no part; neither do those of
another length than the most frequent one (ties: the longer); null ids stay null; repeated rows and vectors are answered each
and fitted once; entries beyond 2**53 / 64 count as that bound; components without variance are left out, so a table
of one distinct vector, or an empty one, gives no rows; a deviation beyond a long is null; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, ship, written

UNITS = 64.0
SHIFT = 1_000_000
BOUND = float(1 << 53)
#: Pivots below so many times the largest, times the dimension, end the factor.
TINY = 2.0 ** -52
#: Columns are orthogonal if their cosine is at most this.
ORTHOGONAL = 1e-15
SWEEPS = 60
#: Partial matrices that reach the driver, at most.
PARTIALS = 8
#: Rows that are worked on at once.
STEP = 4096


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``L`` with ``a = L @ L.T``: a column per pivot, rows in the order of ``a``; largest remaining diagonal first."""
    a = np.array(a, float)
    d = len(a)
    rest, open_ = np.diag(a).copy(), np.ones(d, bool)
    factor = np.zeros((d, d))
    least = TINY * d * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        p = int(np.argmax(np.where(open_, rest, -1.0)))
        if not open_[p] or rest[p] <= least:
            return factor[:, :k]
        column = np.where(open_, a[:, p] - factor[:, :k] @ factor[p, :k], 0.0)
        column[p] = rest[p]
        factor[:, k] = column / np.sqrt(rest[p])
        open_[p] = False
        rest = rest - factor[:, k] ** 2
    return factor


def _rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``r`` columns, as rounds of disjoint pairs (a round-robin tournament)."""
    players = list(range(r + r % 2))
    out = []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(min(x, y), max(x, y)) for x, y in zip(players[:half], reversed(players[half:])) if max(x, y) < r]
        out.append((np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)))
        players = [players[0], players[-1], *players[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of ``factor @ factor.T``."""
    u = np.array(factor, float).T.copy()  # a row per column of the factor
    for _ in range(SWEEPS):
        turned = False
        for i, j in _rounds(len(u)):
            x, y = u[i], u[j]
            alpha, beta, gamma = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            go = np.abs(gamma) > ORTHOGONAL * np.sqrt(alpha * beta)
            if not go.any():
                continue
            turned = True
            i, j, x, y, gamma = i[go], j[go], x[go], y[go], gamma[go]
            zeta = (beta[go] - alpha[go]) / (2 * gamma)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            u[i], u[j] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
        if not turned:
            break
    norm = np.sqrt((u * u).sum(axis=1))
    order = np.argsort(-norm, kind="stable")
    order = order[norm[order] > 0]
    return norm[order] ** 2, (u[order] / norm[order][:, None]).T


@dataclass
class Whitening:
    n: int
    #: exact sums by dimension
    sums: list[int]
    #: unit eigenvectors as columns, and their eigenvalues, of the covariance
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s / self.n for s in self.sums])) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - S) ** 2``, exactly; None beyond a long."""
        rough = self.n * x - np.array(self.sums, float)
        total, out = (rough * rough).sum(axis=1), np.empty(len(x), object)
        small = total < 2.0 ** 61
        if small.any():  # then every factor fits, too
            d = self.n * x[small].astype(np.int64) - np.array(self.sums, np.int64)
            out[small] = (d * d).sum(axis=1)
        for i in np.flatnonzero(~small):
            exact = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums))
            out[i] = exact if exact < 1 << 63 else None
        return out.tolist()


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that take part (see above)."""
    v = F.col(vector_col).cast("array<double>")
    rows = columns(rows, F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    lengths = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if lengths is not None:
        rows = rows.where(F.size("v") == lengths["length"])
    units = F.transform("v", lambda c: F.floor(F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), c * UNITS))) + SHIFT)
    return rows.select("vec_id", units.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of partial results (``part``: doubles as bytes), added up in the cluster to at most ``PARTIALS`` of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer(), float)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    wide = max(1, int(parts.sparkSession.sparkContext.defaultParallelism ** 0.5))
    few = parts.repartition(PARTIALS * wide).mapInArrow(add, "part binary").coalesce(PARTIALS).mapInArrow(add, "part binary")
    return sum((np.frombuffer(r["part"], float) for r in few.collect()), np.zeros(size))


def _second_moments(fitted: DataFrame, image, d: int) -> np.ndarray:
    """Sums of ``y`` and of ``y y'`` over ``y = image(x)``, which has ``d`` columns: one partial a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(d), np.zeros((d, d))
        for batch in batches:
            for a in range(0, batch.num_rows, STEP):
                y = image(_matrix(batch.column(0).slice(a, STEP)))
                first += y.sum(axis=0)
                second += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([first, second.ravel()]).tobytes()], pa.binary())], names=["part"])

    return _added(fitted.select("x").mapInArrow(run, "part binary"), d + d * d)


def fit(vectors: DataFrame, most: int) -> Whitening | None:
    """Components of the distinct ``x`` of ``vectors``, at most ``most``; None without any variance."""
    spark = vectors.sparkSession
    ship(spark)
    fitted = written(spark, vectors.select("x").distinct(), "distinct-vectors")  # copies collapse map-side
    entry = fitted.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n"))
    sums = entry.orderBy("at").collect()  # one row a dimension
    if not sums:
        return None
    n, totals = sums[0]["n"], [int(r["total"]) for r in sums]
    d = len(totals)
    mean = np.array([s / n for s in totals])
    found = _second_moments(fitted, lambda x: x - mean, d)
    first, scatter = found[:d], found[d:].reshape(d, d)
    scatter = scatter - np.outer(first, first) / n  # what rounding of the mean left
    squares, components = one_sided_jacobi(pivoted_cholesky(scatter))
    squares, components = squares[:most], components[:, :most]
    if not len(squares):
        return None
    model = Whitening(n, totals, components, squares / n, squares / np.trace(scatter))
    k = len(squares)
    found = _second_moments(fitted, model.whiten, k)
    covariance = found[k:].reshape(k, k) / n - np.outer(found[:k] / n, found[:k] / n)
    model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    spark = vectors.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows if m is not None else 0, STEP):
                part = batch.slice(a, STEP)
                x = _matrix(part.column(1))
                y, k = m.whiten(x), len(m.values)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                total = len(x) * k
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(total, m.n)), pa.array(m.deviations(x), pa.int64()).take(each), pa.array(y.ravel()),
                    pa.array(np.tile(m.explained, len(x))), pa.array(np.full(total, m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
