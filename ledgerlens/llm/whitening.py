"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, x = floor(64 c) + 1000000.  The model is fitted on each
distinct x vector once:

1. partitions sum the vectors: n and the sums S per dimension are exact;
2. partitions sum the products of the centred vectors: the scatter matrix, d x d;
3. the driver factors scatter / n = L L' by Cholesky with pivoting, which ends at
   the rank, and turns the columns of the triangular factor L by Jacobi rotations until
   they are orthogonal.  L J J' L' is still the covariance, so the squared norms of
   the rotated columns are its eigenvalues and the normalised columns its unit
   eigenvectors, found without squaring the condition number again;
4. one more pass over the distinct vectors measures the covariance of what
   ``whitened`` gives.

Only the matrix, of a size that depends on the dimension alone, passes through the
driver; the rows are scored in one map pass.

Defined results: rows whose vector is null, empty or holds null or non-finite
entries are dropped; so are vectors of another length than the most frequent one (of
equally frequent lengths the largest).  Directions without variance (relative to the
trace, below ``RANK``) are no components: all vectors equal give no rows.  Rows without
an id or with a repeated one are rows of their own.  Entries beyond 2^53 / 64 in size
count as that.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

SCALE, OFFSET = 64.0, 1_000_000
LIMIT = 1 << 53
RANK = 1e-13
SWEEPS = 60
COMPONENTS = 16


@dataclass(frozen=True)
class Whitening:
    """n, the sums S, and the eigenvalues and unit eigenvectors (columns) of the covariance."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        """Rows of x, centred, on the first components, over the root of their eigenvalues."""
        return self.centred(x) @ (self.vectors[:, :components] / np.sqrt(self.values[:components]))


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S / n: the whole part is taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([s % n / n for s in sums])


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """The sum of (n x - S)^2 over the dimensions of each row, exact."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    y = x - whole
    most = (int(np.abs(y).max(initial=0)) + 1) * n
    if most * most * max(len(sums), 1) < 1 << 63:
        d = y * n - np.array(rest, np.int64)
        return (d * d).sum(1).tolist()
    return [sum((n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in y.tolist()]


def pivoted_cholesky(a: np.ndarray, rank: float = RANK) -> np.ndarray:
    """L (d x r) with L L' = a; its rows in the order of the pivots are lower triangular."""
    a, d = a.copy(), len(a)
    limit = rank * max(float(np.trace(a)), 0.0)
    out = np.zeros((d, d))
    for j in range(d):
        pivot = int(np.argmax(np.diag(a)))
        if a[pivot, pivot] <= limit:
            return out[:, :j]
        out[:, j] = a[:, pivot] / np.sqrt(a[pivot, pivot])
        a -= np.outer(out[:, j], out[:, j])
        a[pivot, :] = a[:, pivot] = 0.0  # done: the rest of the factor is 0 in this row
    return out


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors) of factor @ factor', falling, by one-sided rotations.

    Each round of a sweep rotates disjoint pairs of columns, paired as in a
    round-robin tournament, so that a round is a few array operations.
    """
    rows = factor.T.copy()  # a column of the factor is a row here
    r = len(rows)
    seats = np.arange(r + r % 2)
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(max(len(seats) - 1, 0)):
            p, q = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
            pair = (p < r) & (q < r)
            p, q = p[pair], q[pair]
            a, b = rows[p], rows[q]
            aa, bb, ab = ((x * y).sum(1) for x, y in ((a, a), (b, b), (a, b)))
            size = np.sqrt(aa * bb)
            off = np.divide(np.abs(ab), size, out=np.zeros_like(ab), where=size > 0)
            worst = max(worst, float(off.max(initial=0)))
            turn = off > 1e-16
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            rows[p], rows[q] = c[:, None] * a - s[:, None] * b, s[:, None] * a + c[:, None] * b
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst < 1e-15:
            break
    values = (rows * rows).sum(1)
    order = np.argsort(-values, kind="stable")
    return values[order], (rows[order] / np.sqrt(values[order])[:, None]).T


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, of equal lengths, as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def whole_vectors(df: DataFrame, vector: str, carry: str | None = None) -> DataFrame:
    """The rows that take part: (carry,) and x as an array of longs."""
    entry = F.col("v")
    rows = df.select(*([F.col(carry).alias("vec_id")] if carry else []), entry_array(vector).alias("v"))
    fine = F.forall(entry, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    x = F.transform(entry, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))) + OFFSET)
    return rows.where(entry.isNotNull() & (F.size(entry) > 0) & fine).select(*(["vec_id"] if carry else []), x.alias("x"))


def entry_array(vector: str):
    return F.col(vector).cast("array<double>")


def _sum_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, high, low = 0, 0, 0
    for batch in batches:
        x = _matrix(batch.column("x"))
        n += len(x)
        high, low = high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(low)), pa.int32()), pa.array([n] * len(low), pa.int64()),
             pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["place", "n", "high", "low"])


def _sum_products(centre, size: int):
    """Sums of products of the rows that ``centre`` makes of x: the upper triangle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = centre(_matrix(batch.column("x")))
            total += y.T @ y
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i * size + j, pa.int64()), pa.array(total[i, j])], names=["cell", "product"])
    return run


def _products(distinct: DataFrame, centre, size: int) -> np.ndarray:
    """The symmetric matrix of the sums over all partitions."""
    sums = distinct.mapInArrow(_sum_products(centre, size), "cell long, product double")
    rows = sums.groupBy("cell").agg(F.sum("product").alias("product")).toPandas()
    upper = np.zeros(size * size)
    upper[rows["cell"].to_numpy(np.int64)] = rows["product"].to_numpy(np.float64)
    upper = upper.reshape(size, size)
    return upper + upper.T - np.diag(np.diag(upper))


def fit(distinct: DataFrame) -> Whitening | None:
    """The model of the distinct vectors x; None without any variance."""
    sums = (distinct.mapInArrow(_sum_vectors, "place int, n long, high long, low long").groupBy("place")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(19,0)")).alias("high"),
                 F.sum(F.col("low").cast("decimal(19,0)")).alias("low")).orderBy("place").collect())
    if not sums:
        return None
    n, s = int(sums[0].n), tuple((int(r.high) << 32) + int(r.low) for r in sums)
    covariance = _products(distinct, lambda x: _centred(x, n, s), len(s)) / n
    values, vectors = jacobi(pivoted_cholesky(covariance))
    if not len(values):
        return None
    return Whitening(n, s, values, vectors, float(np.trace(covariance)))


SCHEMA = "vec_id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(df: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    kind = df.select(vec_id).schema[0].dataType.simpleString()
    rows = whole_vectors(df, vector, vec_id)
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    rows = rows.where(F.size("x") == (common.size if common else 0))
    distinct = stored(rows.select("x").distinct(), "vectors")
    model = fit(distinct)
    if model is None:
        return df.sparkSession.createDataFrame([], SCHEMA.format(kind))
    count = min(components, len(model.values))
    covariance = _products(distinct, lambda x: model.whitened(x, count), count) / model.n
    error = float(np.abs(covariance - np.eye(count)).max())
    explained = model.values[:count] / model.trace

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal
        for batch in batches:
            x = _matrix(batch.column("x"))
            deviation = pa.array([Decimal(d) for d in deviations(x, model.n, model.sums)], pa.decimal128(38, 0))
            row = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(row)), pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                 pa.array(np.full(len(row), model.n), pa.int64()), deviation.take(pa.array(row)),
                 pa.array(model.whitened(x, count).reshape(-1)), pa.array(np.tile(explained, len(x))),
                 pa.array(np.full(len(row), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(score, SCHEMA.format(kind))
