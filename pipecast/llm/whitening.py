"""Whitening of embeddings by their leading principal components.

Each entry c of a vector, as double, becomes the whole number x = floor(1024 c) + 100000. Spark sums
the vectors exactly, then the products of the centred vectors; each task adds up its own rows and
sends one value a pair of dimensions. The driver gets the covariance (dimension squared, whatever
the number of rows) and finds its leading eigenvectors: Householder reflections make it tridiagonal,
Sturm counts bisect for the eigenvalues, inverse iteration gives the vectors, those of close
eigenvalues made orthogonal to each other. The components travel to the tasks with the function
that projects every row.

Odd rows:

* A null vector, one with a null, NaN or infinite entry, and an empty one has no rows in the result.
* The dimension is the length that most of the remaining vectors have (of equally frequent ones the
  largest); vectors of another length have no rows in the result and are not counted in ``n``.
* Numbers x are held within 2**40 on either side, reached by entries of about a milliard.
* Repeated rows, equal vectors and null ids are rows like all others; only ``vec_id`` and the vector
  column are read, other columns are ignored.
* Fewer than 8 dimensions give as many components. A component without variance (all vectors equal,
  fewer vectors than dimensions) has a null ``whitened`` and takes no part in ``identity_error``.
* ``deviation`` is null where it exceeds a long; ``deviation_whole`` has it then, too.
* An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
# The scale and shift of the whole numbers.
SCALE = 1024.0
SHIFT = 100_000
LARGEST = float(1 << 40)
# Eigenvalues closer than this share of the largest one count as a cluster.
CLUSTER = 1e-3
EPS = float(np.finfo(float).eps)

SCHEMA = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_whole decimal(38,0)"
)


# --- eigenvectors of a symmetric matrix ---------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) by Householder reflections; reflector k acts on the rows after k."""
    a = np.array(matrix, float)
    size = len(a)
    reflectors = []
    for k in range(size - 2):
        column = a[k + 1 :, k].copy()
        length = np.linalg.norm(column)
        if np.linalg.norm(column[1:]) <= EPS * EPS * length or length == 0:
            reflectors.append(np.zeros(len(column)))
            continue
        column[0] += np.copysign(length, column[0])
        v = column / np.linalg.norm(column)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2.0 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each value of ``at``: the negative terms of the Sturm sequence."""
    scale = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    floor = EPS * EPS * scale + np.finfo(float).tiny
    below = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < floor, -floor, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues in falling order, each bisected until its ends are neighbours."""
    size = len(diagonal)
    around = np.concatenate([[0.0], np.abs(off), [0.0]])
    radius = around[:-1] + around[1:]
    bound = max(np.abs(diagonal - radius).max(), np.abs(diagonal + radius).max()) * (1 + 4 * EPS) + np.finfo(float).tiny
    low, high = np.full(count, -bound), np.full(count, bound)
    wanted = size - np.arange(count)  # the k-th largest is the first with so many at or below it
    for _ in range(200):
        middle = 0.5 * (low + high)
        if np.all((middle <= low) | (middle >= high)):
            break
        above = sturm_counts(diagonal, off, middle) >= wanted
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return 0.5 * (low + high)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solve (T - shift) z = b by elimination with row exchanges; tiny pivots are lifted to ``floor``."""
    size = len(diagonal)
    pivot, second, third = diagonal - shift, np.append(off, 0.0), np.zeros(size)
    factor, swapped = np.zeros(size), np.zeros(size, bool)
    for i in range(size - 1):
        under = off[i]
        if abs(under) > abs(pivot[i]):
            swapped[i] = True
            factor[i] = pivot[i] / under
            here, right, far = under, pivot[i + 1], second[i + 1]
            pivot[i + 1] = second[i] - factor[i] * right
            second[i + 1] = -factor[i] * far
            pivot[i], second[i], third[i] = here, right, far
        else:
            if abs(pivot[i]) < floor:
                pivot[i] = floor
            factor[i] = under / pivot[i]
            pivot[i + 1] -= factor[i] * second[i]
    if abs(pivot[-1]) < floor:
        pivot[-1] = floor

    def solve(b: np.ndarray) -> np.ndarray:
        z = b.copy()
        for i in range(size - 1):
            if swapped[i]:
                z[i], z[i + 1] = z[i + 1], z[i]
            z[i + 1] -= factor[i] * z[i]
        for i in range(size - 1, -1, -1):
            if i + 1 < size:
                z[i] -= second[i] * z[i + 1]
            if i + 2 < size:
                z[i] -= third[i] * z[i + 2]
            z[i] /= pivot[i]
        return z

    return solve


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one column for each of the falling ``values``."""
    size = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    floor = EPS * scale
    random = np.random.default_rng(11)
    vectors = np.zeros((size, len(values)))
    first = 0  # where the cluster of the present value begins
    shift = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * scale:
            first = k
        # Equal values get shifts a few units apart, so that their systems differ.
        shift = min(value, shift - 4 * floor) if k > first else value
        solve = _solver(diagonal, off, shift, floor)
        z = random.standard_normal(size)
        for _ in range(6):
            z = solve(z / np.linalg.norm(z))
            z /= np.abs(z).max()
            for _ in range(2):  # twice is enough
                for j in range(first, k):
                    z -= (vectors[:, j] @ z) * vectors[:, j]
        vectors[:, k] = z / np.linalg.norm(z)
    return vectors


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a symmetric matrix, largest first.

    The entry of largest size in a vector is positive.
    """
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, count)
    vectors = inverse_iteration(diagonal, off, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        vectors[k + 1 :] -= 2.0 * np.outer(v, v @ vectors[k + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    lead = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[lead, np.arange(count)])


# --- sums over all rows -------------------------------------------------------------------------


def _vectors(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, lengths, flat entries) of the rows whose vector is whole and finite."""
    arrays = batch.column(column)
    if pa.types.is_null(arrays.type) or not len(arrays):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    lengths = arrays.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    flat = arrays.flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)  # nulls become NaN
    starts = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    fine = (lengths > 0) & (bad[starts[1:]] == bad[starts[:-1]])
    return np.flatnonzero(fine), lengths[fine], flat[np.repeat(fine, lengths)]


def _whole(batch: pa.RecordBatch, column: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, x) of the rows with ``size`` whole and finite entries."""
    rows, lengths, flat = _vectors(batch, column)
    fits = lengths == size
    entries = flat[np.repeat(fits, lengths)].reshape(-1, size)
    x = np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST).astype(np.int64) + SHIFT
    return rows[fits], x


def _dimension(df: DataFrame, column: str) -> int:
    """The length of most vectors, 0 if there is none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for size, times in zip(*np.unique(_vectors(batch, column)[1], return_counts=True)):
                seen[int(size)] = seen.get(int(size), 0) + int(times)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["size", "n"])

    sizes = df.select(column).mapInArrow(count, "size int, n long").groupBy("size").agg(F.sum("n").alias("n"))
    row = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return row["size"] if row else 0


def _sums(df: DataFrame, column: str, size: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sum of each dimension)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            rows, x = _whole(batch, column, size)
            n += len(rows)
            total += x.sum(axis=0).astype(object)
        if n:
            columns = [pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "total"])

    added = df.select(column).mapInArrow(add, "i int, n long, total decimal(38,0)")
    rows = added.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    return (rows[0]["n"], [int(r["total"]) for r in rows]) if rows else (0, [0] * size)


def _moments(df: DataFrame, column: str, size: int, values: Callable[[np.ndarray], np.ndarray], width: int, order: int) -> np.ndarray:
    """Sums over all rows of ``values(x)`` (order 1) or of the products of its columns (order 2).

    Each task adds up its own rows; Spark adds the tasks.
    """
    i, j = np.triu_indices(width) if order == 2 else (np.arange(width), np.zeros(width, int))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = _whole(batch, column, size)
            if len(x):
                z = values(x)
                part = (z.T @ z)[i, j] if order == 2 else z.sum(axis=0)
                total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "total"])

    added = df.select(column).mapInArrow(add, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    table = added.toArrow()
    out = np.zeros((width, width) if order == 2 else width)
    i, j, total = (table[c].to_numpy() for c in ("i", "j", "total"))
    if order == 1:
        out[i] = total
    else:
        out[i, j] = out[j, i] = total
    return out


# --- the operator -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """``sums`` of the ``n`` whole-number vectors; ``components`` as columns, by falling ``eigenvalues``.

    ``explained``: shares of the total variance; ``has_variance`` tells which components can be scaled.
    """

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    has_variance: np.ndarray
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Unit-variance coordinates of the rows of ``x``; NaN where a component has no variance."""
        scale = np.sqrt(np.where(self.has_variance, self.eigenvalues, np.nan))
        return (x - self.mean) @ self.components / scale


def fit_whitening(df: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> Whitening | None:
    """Components of the vectors in ``column``; None without any."""
    size = _dimension(df, column)
    if not size:
        return None
    n, sums = _sums(df, column, size)
    mean = np.array([s / n for s in sums])
    covariance = _moments(df, column, size, lambda x: x - mean, size, 2) / n
    values, vectors = leading_components(covariance, min(count, size))
    trace = float(np.trace(covariance))
    varies = values > size * EPS * max(trace, 0.0)
    explained = values / trace if trace > 0 else np.zeros(len(values))
    fitted = Whitening(n, sums, values, vectors, explained, varies)
    kept = int(varies.sum())  # eigenvalues fall, so these come first
    if not kept:
        return fitted
    centre = _moments(df, column, size, lambda x: fitted.project(x)[:, :kept], kept, 1) / n
    spread = _moments(df, column, size, lambda x: fitted.project(x)[:, :kept] - centre, kept, 2) / n
    error = float(np.abs(spread - np.eye(kept)).max())
    return Whitening(n, sums, values, vectors, explained, varies, error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over the dimensions of (n x - S)**2 for each row, as Python numbers.

    Differences are cut into limbs whose squares add up within 64 bits.
    """
    if not len(x):
        return []
    size = x.shape[1]
    largest = n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in sums)
    limb = (62 - size.bit_length()) // 2
    if largest >= 1 << (2 * limb):
        total = np.array(sums, object)
        return [int(((n * row.astype(object) - total) ** 2).sum()) for row in x]
    d = n * x - np.array(sums, np.int64)
    high, low = d >> limb, d & ((1 << limb) - 1)
    parts = [(high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)]
    return [(int(a) << (2 * limb)) + (int(b) << (limb + 1)) + int(c) for a, b, c in zip(*parts)]


def whiten(df: DataFrame, fitted: Whitening | None, column: str = "embedding") -> DataFrame:
    """One row for each usable row of ``df`` and component; see the module for odd rows."""
    kind = df.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {SCHEMA}"
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    size, count = fitted.components.shape
    top = (1 << 63) - 1

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _whole(batch, column, size)
            if not len(rows):
                continue
            each = np.repeat(np.arange(len(rows)), count)
            spread = deviations(x, fitted.n, fitted.sums)
            columns = [
                batch.column("vec_id").take(pa.array(rows[each])),
                pa.array(np.tile(np.arange(1, count + 1), len(rows)), pa.int32()),
                pa.array(np.full(len(each), fitted.n), pa.int64()),
                pa.array([d if d <= top else None for d in spread], pa.int64()).take(pa.array(each)),
                pa.array(fitted.project(x).ravel(), pa.float64(), from_pandas=True),
                pa.array(np.tile(fitted.explained, len(rows)), pa.float64()),
                pa.array([fitted.identity_error] * len(each), pa.float64()),
                pa.array([Decimal(d) for d in spread], pa.decimal128(38, 0)).take(pa.array(each)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", *[c.split()[0] for c in SCHEMA.split(", ")]])

    return df.select("vec_id", column).mapInArrow(project, schema)
