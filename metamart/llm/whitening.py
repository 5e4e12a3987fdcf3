"""Embedding whitening by shifted CholeskyQR (op13).

Every entry c becomes the integer floor(256 c).  The fit list is each distinct
integer vector once.  Its centred rows A are never stored: a pass over the fit
list forms the Gram matrix of A R^-1 for the triangular factors R found so far
(one triangular solve per batch of rows), sums it over the tasks, and its
Cholesky factor is the next one.  The first pass adds a shift to the diagonal,
so that the factor exists whatever the condition of A; later passes add one only
where the Gram matrix is singular to rounding.  After the pass that finds the
columns orthonormal, the product of the factors is the R of A = Q R, and the
singular values and right vectors of this small R are those of A: components and
n times their variances.  A covariance matrix, whose condition is the square of
A's, is never decomposed.

The driver holds matrices of the size of one vector squared and nothing that
grows with the rows.  The Gram matrices are summed by Spark, an entry per row.

Defined results.  Vectors that are null or hold a null or non-finite entry are
dropped; repeated vec_ids and rows keep all their rows; a null vec_id stays null.
Vectors are as long as the longest; shorter ones are filled up with zeros (empty
vectors are zeros).  ``floor(256 c)`` is held within +-2^62.  A component of no variance
(fewer distinct vectors or independent columns than components) has a null
``whitened``; ``explained`` is null where nothing varies; ``identity_error`` is
over the components that vary, null where none does.  ``deviation`` is null where
the exact number does not fit in a long.  Vectors of fewer than four entries have
as many components as entries.  An empty table gives no rows.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.llm.common import materialize

SCALE = 256
COMPONENTS = 4
PASSES = 10
LIMIT = float(2**62)
ORTHONORMAL = 1e-13          # columns are orthonormal within this times the row length
NO_VARIANCE = 1e-20          # variances below this share of the largest are none
BATCH = 4096


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column without nulls, and the lengths of its lists."""
    kind = pa.list_(pa.float64()) if pa.types.is_floating(column.type.value_type) else column.type
    column = column.cast(kind)
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _rows(column: pa.Array, d: int) -> np.ndarray:
    """Lists as rows of d entries, shorter lists filled up with zeros."""
    values, sizes = _flat(column)
    if (sizes == d).all():
        return values.reshape(-1, d)
    out = np.zeros((len(sizes), d), values.dtype)
    out[np.arange(d) < sizes[:, None]] = values
    return out


def _whole(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values * SCALE), -LIMIT, LIMIT).astype(np.int64)


def integer_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, x array<long> of the rows whose vector is complete and finite."""
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias(vector)).where(
        F.col(vector).isNotNull() & ok)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, sizes = _flat(b.column(1))
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(_whole(values)))], ["vec_id", "x"])

    return rows.mapInArrow(run, "vec_id bigint, x array<bigint>")


def fit_list(vectors: DataFrame) -> DataFrame:
    """Every distinct vector once, written to shared storage."""
    d = vectors.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    zeros = F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(d) - F.size("x"), F.lit(0)))
    padded = vectors.select(F.when(F.size("x") < d, F.concat("x", zeros)).otherwise(F.col("x")).alias("x"))
    return materialize(padded.distinct(), "fit-list")


class Centre:
    """n and the exact sums of the columns of the fit list."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.small = max(map(abs, sums), default=0) < 2**61 // max(n, 1)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly, as longs or, where they could overflow, as Python integers."""
        if len(x) and (not self.small or int(np.abs(x).max()) * self.n >= 2**61):
            return x.astype(object) * self.n - np.array(self.sums, dtype=object)
        return x * self.n - np.array(self.sums, np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return (self.scaled(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        scaled = self.scaled(x)
        if scaled.size and max(int(np.abs(scaled).max()), 1) ** 2 * scaled.shape[1] >= 2**62:
            scaled = scaled.astype(object)
        total = (scaled * scaled).sum(axis=1) if scaled.shape[1] else np.zeros(len(scaled), np.int64)
        return [int(t) if int(t) < 2**63 else None for t in total]


def centre(fit: DataFrame, d: int) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for b in batches:
            x = _rows(b.column(0), d)
            n += len(x)
            for lo in range(0, len(x), BATCH):
                part = x[lo:lo + BATCH]
                exact = part.astype(object) if int(np.abs(part).max(initial=0)) >= 2**48 else part
                sums = [a + int(s) for a, s in zip(sums, exact.sum(axis=0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(d)], pa.int32()), pa.array([str(s) for s in (n, *sums)])], ["i", "s"])

    totals = {r.i: int(r.s) for r in fit.mapInArrow(run, "i int, s string").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}        # d + 1 rows
    return Centre(totals.get(-1, 0), [totals[i] for i in range(d)] if totals else [])


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows R1^-1 R2^-1 ... for upper triangular factors."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(rows.shape[1]):               # forward substitution, all rows at once
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def gram(fit: DataFrame, d: int, of) -> np.ndarray:
    """Sum over the fit list of v v^T for the rows v that ``of`` makes of x (m per row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = _rows(b.column(0), d)
            for lo in range(0, len(x), BATCH):
                v = of(x[lo:lo + BATCH])
                total = v.T @ v if total is None else total + v.T @ v
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    entries = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (entries.column(k).to_numpy() for k in range(3))
    out = np.zeros((max(i, default=-1) + 1,) * 2)
    out[i, j] = out[j, i] = v
    return out


def triangular_factor(fit: DataFrame, d: int, mid: Centre) -> np.ndarray:
    """R of A = Q R with orthonormal Q, by shifted CholeskyQR (up to a rotation, which
    singular values and right vectors do not see; as many rows as A has rank)."""
    eps = np.finfo(float).eps / 2
    factors: list[np.ndarray] = []
    r = np.eye(d)
    for k in range(PASSES):
        g = gram(fit, d, lambda x, f=tuple(factors): _solved(mid.rows(x), f))
        if not g.any():
            return np.zeros((d, d))
        values, vectors = np.linalg.eigh(g)
        if k and (np.minimum(np.abs(values - 1), np.abs(values)) <= ORTHONORMAL * d).all():
            return vectors[:, values > 0.5].T @ r     # the zeros are directions without variance
        # of the order that bounds the rounding of the sum and of the factorisation
        shift = 11 * (min(mid.n, 10_000) * d + d * (d + 1)) * eps * values[-1]
        singular = values[0] < shift if k else True
        factor = np.linalg.cholesky(g + shift * np.eye(d) if singular else g).T
        factors.append(factor)
        r = factor @ r
    return r


class Whitening:
    def __init__(self, mid: Centre, components: np.ndarray, variances: np.ndarray, trace: float):
        self.centre, self.components, self.variances, self.trace = mid, components, variances, trace

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN for components of no variance."""
        root = np.sqrt(np.where(self.variances > 0, self.variances, np.nan))
        return self.centre.rows(x) @ self.components / root


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    mid = centre(fit, d)
    _, s, w = np.linalg.svd(triangular_factor(fit, d, mid))
    variances = np.zeros(d)
    variances[:len(s)] = s * s / max(mid.n, 1)
    variances[variances <= NO_VARIANCE * variances.max(initial=0)] = 0
    return Whitening(mid, w[:components].T, variances[:components], float(variances.sum()))


def identity_error(fit: DataFrame, d: int, model: Whitening) -> float | None:
    """Largest entry of the whitened covariance minus the identity, over the fit list."""
    vary = model.variances > 0
    if not vary.any():
        return None
    m = int(vary.sum())
    # a column of ones beside the coordinates gives their sums
    g = gram(fit, d, lambda x: np.column_stack([model(x)[:, vary], np.ones(len(x))]))
    mean = g[m, :m] / model.centre.n
    return float(np.abs(g[:m, :m] / model.centre.n - np.outer(mean, mean) - np.eye(m)).max())


def whitened(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    vectors = integer_vectors(embeddings, vector)
    fit = fit_list(vectors)
    d = fit.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not d:
        return vectors.sparkSession.createDataFrame([], schema)
    model = fit_whitening(fit, d, components)
    error = identity_error(fit, d, model)
    k = len(model.variances)
    shares = [float(v / model.trace) if model.trace > 0 else None for v in model.variances]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                x = _rows(part.column(1), d)
                m = len(x)
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array([model.centre.n] * (m * k), pa.int64()),
                    pa.array(model.centre.deviations(x), pa.int64()).take(at),
                    pa.array(model(x).ravel(), from_pandas=True), pa.array(shares * m, pa.float64()),
                    pa.array([error] * (m * k), pa.float64()),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
