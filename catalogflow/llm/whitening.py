"""Whitening of vectors: distributed centred covariance, its leading eigenvectors, and a projection of every vector.

Entries c become integers x = floor(64 c) + 1000000, so that counts and sums are exact. The covariance is summed from centred
products, one small matrix for each partition. On the driver, whose work depends on the length of the vectors alone, Householder reflections make it
tridiagonal, bisection on Sturm counts finds the leading eigenvalues, and inverse iteration their vectors, which are made
orthogonal to those before them in a cluster of close eigenvalues and reflected back. The projection is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import by_batch, small_batches

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**52  # of a scaled entry: up to here its floor is an exact integer
CLOSE = 1e-3  # eigenvalues nearer than this share of the largest are a cluster
NO_VARIANCE = 1e-11  # a component with less than this share of the largest variance has none but rounding
EPS = float(np.finfo(np.float64).eps)
WHITE_SCHEMA = "vec_id long, deviation decimal(38,0), whitened array<double>"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) without null vectors, null or non-finite entries, and entries too large for exact integers; of the most frequent length."""
    e = F.col("embedding")
    wrong = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * SCALE >= LARGEST))
    good = vectors.select(F.col("vec_id").cast("long"), e.cast("array<double>").alias("embedding")).where("embedding IS NOT NULL").where(~wrong)
    size = good.groupBy(F.size("embedding").alias("s")).count().orderBy(F.desc("count"), "s").first()
    return good.where(F.size("embedding") == (size["s"] if size else 0))


def integers(batch: pa.RecordBatch) -> np.ndarray:
    """The integer vectors of a batch as rows."""
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(batch.num_rows, -1) + SHIFT


@dataclass
class Centre:
    """Number of vectors and their exact sums, by dimension: the mean is ``whole + rest / n``."""

    n: int
    sums: list[int]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean: an exact difference of integers less a fraction."""
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Sums over dimensions of (n x - S) ** 2, exact at any size."""
        y = x - self.whole
        most = int(np.abs(y).max(initial=0)) + 1
        if (self.n * most) ** 2 * x.shape[1] < 2**63:
            return ((self.n * y - self.rest) ** 2).sum(1)
        wide = self.n * y.astype(object) - self.rest.astype(object)
        return [int(v) for v in (wide * wide).sum(1)]


def centre(good: DataFrame) -> Centre | None:
    """Exact count and sums; nothing for an empty table or vectors without entries."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                own = integers(batch).sum(0).astype(object)
                n, sums = n + batch.num_rows, own if sums is None else sums + own
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()), pa.array([str(s) for s in sums], pa.string())],
                names=["i", "n", "s"])

    small_batches(good.sparkSession)
    found = good.select("embedding").mapInArrow(partial, "i int, n long, s string").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()  # a row for each dimension
    return Centre(found[0]["n"], [int(r["s"]) for r in found]) if found else None


def products(good: DataFrame, at: Centre, projection: np.ndarray | None = None) -> np.ndarray:
    """The covariance (divisor n) of the centred vectors, or of their projections.

    Each partition gives the upper triangle of one matrix; the cells are summed by position.
    """
    shared = good.sparkSession.sparkContext.broadcast((at, projection))  # sums and components: sized by the vectors' length
    size = len(at.sums) if projection is None else projection.shape[1]
    upper = np.triu_indices(size)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, p = shared.value
        total = np.zeros((size, size))
        rows = 0
        for batch in batches:
            if batch.num_rows:
                z = mine.centred(integers(batch))
                z = z if p is None else z @ p
                total += z.T @ z
                rows += batch.num_rows
        if rows:
            yield pa.RecordBatch.from_arrays([
                pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])], names=["i", "j", "v"])

    small_batches(good.sparkSession)
    cells = good.select("embedding").mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((size, size))
    i, j = cells["i"].to_numpy(), cells["j"].to_numpy()
    out[i, j] = out[j, i] = cells["v"].to_numpy() / at.n
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of a symmetric matrix: reflecting by them in turn makes it tridiagonal."""
    a = a.copy()
    n = len(a)
    mirrors = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if np.linalg.norm(v[1:]) == 0:
            mirrors.append(np.zeros_like(v))
            continue
        end = -length if v[0] > 0 else length
        v[0] -= end
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = end
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(d: np.ndarray, e: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each shift."""
    tiny = np.finfo(np.float64).tiny / EPS
    q = d[0] - shifts
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - shifts - e[i - 1] ** 2 / q
        count += q < 0
    return count


def leading(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection on the counts."""
    n = len(d)
    around = np.abs(np.concatenate([[0], e])) + np.abs(np.concatenate([e, [0]]))
    least, most = (d - around).min(), (d + around).max()
    room = EPS * n * max(abs(least), abs(most)) + np.finfo(np.float64).tiny
    low, high = np.full(k, least - room), np.full(k, most + room)
    wanted = n - np.arange(k)  # this many lie below a shift that is over the j-th largest
    while True:
        middle = (low + high) / 2
        over = below(d, e, middle) >= wanted
        low, high = np.where(over, low, middle), np.where(over, middle, high)
        if ((high - low) <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)) + np.finfo(np.float64).tiny).all() or ((middle == low) | (middle == high)).all() and (high - low).max() <= room:
            return (low + high) / 2


def solver(d: np.ndarray, e: np.ndarray, shift: float, tiny: float):
    """Solve (T - shift) x = b by elimination with row exchanges, pivots that vanish replaced by ``tiny``."""
    n = len(d)
    u = np.zeros((n, 3))  # the rows after elimination: diagonal and two beyond it
    factor, swapped = np.zeros(n), np.zeros(n, dtype=bool)
    row = [d[0] - shift, e[0] if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        following = [e[i], d[i + 1] - shift, e[i + 1] if i + 2 < n else 0.0]
        if abs(following[0]) > abs(row[0]):
            row, following, swapped[i] = following, row, True
        if abs(row[0]) < tiny:
            row[0] = tiny if row[0] >= 0 else -tiny
        u[i] = row
        factor[i] = following[0] / row[0]
        row = [following[1] - factor[i] * row[1], following[2] - factor[i] * row[2], 0.0]
    u[n - 1, 0] = row[0] if abs(row[0]) >= tiny else (tiny if row[0] >= 0 else -tiny)

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            x[i] -= u[i, 1] * (x[i + 1] if i + 1 < n else 0.0) + u[i, 2] * (x[i + 2] if i + 2 < n else 0.0)
            x[i] /= u[i, 0]
        return x

    return solve


def vectors_of(d: np.ndarray, e: np.ndarray, values: np.ndarray, seed: int = 7) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration, orthogonal to the earlier ones of their cluster."""
    n, rng = len(d), np.random.default_rng(seed)
    norm = max(np.abs(d).max(), np.abs(e).max(initial=0.0), np.finfo(np.float64).tiny)
    out = np.zeros((n, len(values)))
    start, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * norm:
            start = j
        shift = value if j == start else min(value, shift - 4 * EPS * norm)  # equal shifts would give equal vectors
        solve = solver(d, e, shift, EPS * norm)
        before = out[:, start:j]
        x = rng.normal(size=n)
        for _ in range(8):
            x /= np.linalg.norm(x)
            x = solve(x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= before @ (before.T @ x)
            if np.linalg.norm(x) < 1e-6:  # it lay among the earlier ones
                x = rng.normal(size=n)
        out[:, j] = x / np.linalg.norm(x)
        for _ in range(2):
            out[:, j] -= before @ (before.T @ out[:, j])
            out[:, j] /= np.linalg.norm(out[:, j])
    return out


def eigen(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.abs(a).max()
    if scale == 0:
        return np.zeros(k), np.eye(len(a))[:, :k]
    d, e, mirrors = tridiagonal(a / scale)
    values = leading(d, e, k)
    columns = vectors_of(d, e, values)
    for i in range(len(mirrors) - 1, -1, -1):
        columns[i + 1 :] -= 2 * np.outer(mirrors[i], mirrors[i] @ columns[i + 1 :])
    return values * scale, columns


@dataclass
class Whitening:
    """A fitted whitening: centre, components (columns), their variances, the whole variance, and how far from white the fit list is."""

    at: Centre
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.trace


def fit(vectors: DataFrame, k: int = 32) -> Whitening | None:
    """The whitening of all usable vectors: at most ``k`` components, and none without variance. Nothing where there is no variance at all."""
    good = usable(vectors)
    at = centre(good)
    if at is None:
        return None
    v = products(good, at)
    values, columns = eigen(v, min(k, len(v)))
    some = values > NO_VARIANCE * values[0] if values[0] > 0 else np.zeros(len(values), dtype=bool)
    if not some.any():
        return None
    values, columns = values[some], columns[:, some]
    white = products(good, at, columns / np.sqrt(values))
    return Whitening(at, columns, values, float(np.trace(v)), float(np.abs(white - np.eye(len(values))).max()))


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of every usable vector of the fitted length, in one pass without a shuffle.

    Null vectors, vectors with null or non-finite entries or entries of 2 ** 46 and more, and vectors of another length than most
    are left out. Repeated and null ids are vectors of their own; further columns are ignored; an empty table gives no rows.
    A deviation over 38 digits is null.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((model.at, model.components / np.sqrt(model.variances)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, projection = shared.value
        x = integers(batch)
        far = at.deviations(x)
        far = pa.array(far).cast(pa.decimal128(38, 0)) if isinstance(far, np.ndarray) else pa.array([v if v < 10**38 else None for v in far], pa.decimal128(38, 0))
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), far, pa.array(list(at.centred(x) @ projection), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    good = usable(vectors)
    return by_batch(good.where(F.size("embedding") == len(model.at.sums)), run, WHITE_SCHEMA)
