"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Tasks sum what is no larger than d * d numbers each: entries, then products of
centred entries, then products of whitened ones. The driver factors one d * d
matrix: a Cholesky factorisation with diagonal pivots gives V = L L', rotations
from the right make the columns of L orthogonal, and then squared column norms
are the eigenvalues of V and the columns of unit length its eigenvectors.

Entries are whole numbers and are centred on the whole number next to their
mean, so that sums of products are exact in doubles below 2**53, whatever the
order; what the centre lacks (half a unit at most) is taken off in whole numbers
on the driver. A sum beyond that is rounded as doubles are.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import need, small_batches

#: An entry c stands as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components that are returned at most.
COMPONENTS = 8
#: Tasks that add up the sums of all others: the driver gets as many rows at most.
MERGERS = 8


def entries(df: DataFrame, vector: str = "embedding", d: int | None = None) -> DataFrame:
    """df without the rows whose vector is null, empty or holds null or non-finite entries (or is not of length d)."""
    v = F.col(vector)
    whole = F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    return df.filter(whole if d is None else whole & (F.size(v) == d))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of whole numbers x, as doubles."""
    flat = np.asarray(column.flatten()).astype(np.float64)
    return np.clip(np.floor(SCALE * flat.reshape(-1, d)), -(2.0**63), 2.0**63) + SHIFT


def _added(df: DataFrame, vector: str, d: int, width: int, of) -> list[Fraction]:
    """Sum over all rows of what `of` gives for a matrix of rows: `width` doubles. Parts are added in a fixed order, in two levels."""

    def parts(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch.column(0), d))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["part", "total"])

    def merged(batches) -> Iterator[pa.RecordBatch]:
        first, total = -1, np.zeros(width)
        for batch in batches:
            for p, t in zip(batch.column("part").to_pylist(), batch.column("total").to_numpy(zero_copy_only=False)):
                first = p if first < 0 else first
                total = total + t
        if first >= 0:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["part", "total"])

    schema = "part bigint, total array<double>"
    made = df.select(vector).mapInArrow(parts, schema)
    made = made.repartition(MERGERS, "part").sortWithinPartitions("part").mapInArrow(merged, schema)
    return [sum(x, Fraction(0)) for x in zip(*[[Fraction(v) for v in r["total"]] for r in made.orderBy("part").collect()])]


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, L): the rows and columns of v in the order of the pivots are L L', with L lower triangular, of as many columns as v has rank."""
    a = v.copy()
    d = len(a)
    order = np.arange(d)
    low = np.zeros((d, d))
    tiny = d * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    rank = 0
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > tiny:
            break
        for x in (a, a.T, low):
            x[[k, p]] = x[[p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
        rank += 1
    return order, low[:, :rank]


def jacobi(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """low times a rotation, with orthogonal columns: pairs of columns that share none are rotated at once, in the order of a round-robin tournament."""
    r = low.shape[1]
    n = r + r % 2
    w = np.zeros((low.shape[0], n))
    w[:, :r] = low
    ring = np.arange(n)
    least = np.finfo(float).eps * np.sqrt(max(1, low.shape[0]))
    for _ in range(sweeps):
        turns = 0
        for _ in range(max(1, n - 1) if n else 0):
            p, q = ring[: n // 2], ring[n // 2 :][::-1]
            a, b = w[:, p], w[:, q]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(alpha * beta)
            turn = np.abs(gamma) > least * size
            turns += int(turn.sum())
            safe = np.where(turn, gamma, 1.0)
            zeta = (beta - alpha) / (2 * safe)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            w[:, p], w[:, q] = c * a - s * b, s * a + c * b
            ring = np.r_[ring[:1], ring[-1:], ring[1:-1]]
        if not turns:
            return w[:, :r]
    raise ArithmeticError("the rotations did not end")


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance, falling, and unit eigenvectors as columns; as many as it has rank. The largest entry of a vector is positive."""
    order, low = pivoted_cholesky(v)
    turned = np.zeros((len(v), low.shape[1]))
    turned[order] = jacobi(low)
    norms = np.sqrt((turned * turned).sum(0))
    rank = np.argsort(-norms, kind="stable")
    vectors = turned[:, rank] / norms[rank] if len(rank) else turned
    big = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])] if vectors.shape[1] else np.zeros(0)
    return norms[rank] ** 2, vectors * np.where(big < 0, -1.0, 1.0)


class Fit:
    """n, sums S, the covariance V of the rows of df, its eigenvalues and components; null rows and such are left out, see `entries`."""

    def __init__(self, df: DataFrame, vector: str = "embedding"):
        need(df, vector)
        spark = df.sparkSession
        small_batches(spark, 10_000)
        rows = entries(df, vector)
        sizes = [r[0] for r in rows.select(F.size(vector).alias("d")).distinct().limit(2).collect()]
        if len(sizes) > 1:
            raise ValueError(f"vectors of several lengths: {sorted(sizes)} and maybe more")
        self.vector, self.d, self.n = vector, (sizes or [0])[0], 0
        if not sizes:
            return
        d = self.d
        sums = _added(rows, vector, d, d + 1, lambda x: np.r_[len(x), x.sum(0)])
        n = self.n = int(sums[0])
        self.sums = [int(s) for s in sums[1:]]
        centre = np.array([float(round(Fraction(s, n))) for s in self.sums])

        def products(x: np.ndarray) -> np.ndarray:
            y = x - centre
            return np.r_[y.sum(0), (y.T @ y)[np.triu_indices(d)]]

        got = _added(rows, vector, d, d + d * (d + 1) // 2, products)
        rest, upper = got[:d], got[d:]
        v = np.zeros((d, d))
        for k, (i, j) in enumerate(zip(*np.triu_indices(d))):
            v[i, j] = v[j, i] = float((n * upper[k] - rest[i] * rest[j]) / n**2)
        self.covariance, self.trace = v, float(v.trace())
        self.values, self.components = eigen(v)
        self.values, self.components = self.values[:COMPONENTS], self.components[:, :COMPONENTS]
        self.mean = np.array([float(Fraction(s, n)) for s in self.sums])
        k = len(self.values)
        if not k:
            self.identity_error = 0.0
            return
        project = self._project()

        def again(x: np.ndarray) -> np.ndarray:
            w = project(x)
            return np.r_[w.sum(0), (w.T @ w).ravel()]

        got = np.array([float(s / n) for s in _added(rows, vector, d, k + k * k, again)])
        found = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        self.identity_error = float(np.abs(found - np.eye(k)).max())

    def _project(self):
        mean, to = self.mean, self.components / np.sqrt(self.values)
        return lambda x: (x - mean) @ to


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * x - S) ** 2, exact."""
    limit = max((n * int(np.abs(x).max(initial=0)), *map(abs, sums)))
    if limit < 2**61:
        off = n * x.astype(np.int64) - np.array(sums, np.int64)
        most = int(np.abs(off).max(initial=0))
        if most * most * max(1, len(sums)) < 2**63:
            return pc.cast(pa.array((off * off).sum(1)), pa.decimal128(38, 0))
    whole = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([w if w < 10**38 else None for w in whole], pa.decimal128(38, 0))


def whiten(df: DataFrame, fit: Fit | None = None, vector: str = "embedding") -> DataFrame:
    """A row for each row of df and component: its other columns, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or empty or holds a null, NaN or infinite entry
    give nothing, as does an empty table. Vectors of several lengths raise
    ValueError. Repeated rows count as often as they stand. A covariance of
    lower rank has as many components as its rank (none if all vectors are
    equal). deviation is decimal(38, 0), null beyond it. Columns of df with the
    names of the result are replaced.
    """
    fit = fit or Fit(df, vector)
    made = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    others = [c for c in df.columns if c not in (vector, *made)]
    k = len(fit.values) if fit.n else 0
    rows = entries(df, vector, fit.d)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in others), "deviation decimal(38, 0)", "whitened array<double>"])
    if k:
        d, n, sums, project = fit.d, fit.n, fit.sums, fit._project()

        def each(batches):
            for batch in batches:
                x = _matrix(batch.column(vector), d)
                flat = project(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(flat.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], _deviations(x, n, sums), lists], names=[*others, "deviation", "whitened"])

        out = rows.select(*others, vector).mapInArrow(each, schema)
    else:
        out = df.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values]) if k else F.array().cast("array<double>")
    out = out.select(*others, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        *others, (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"),
        F.lit(fit.identity_error if k else 0.0).alias("identity_error"),
    )


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    rows = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
