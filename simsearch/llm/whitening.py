"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries. A vector with a null or non-finite entry, or none at all, is left out. An entry c, as a double, becomes the whole number
x = floor(scale * c) + SHIFT. The fit list holds each distinct x vector once; it is made by one ``distinct`` over packed entries, whose
copies meet in their task before anything is shuffled.

Scatter. With S the sums of the n vectors of the fit list, every vector is centred on m, the whole numbers next to S / n, and only then
multiplied. Tasks add whole numbers, and what the rounding of m leaves out is taken off as n * sum(zz') - tt' with t = S - n m, in whole
numbers too, so the covariance is the exact one, rounded once, however the rows are dealt out. The driver holds dim x dim numbers.

Factor. V = L L' with the largest remaining diagonal taken first. Rotations from the right make the columns of L
orthogonal: their lengths squared are the eigenvalues, the columns at unit length the components (with the pivoting undone). A component
has its largest entry positive.

Whitening projects x - S / n on the components and divides by the square root of the eigenvalue. The check of the result is a pass of its own:
the covariance of the whitened fit list against the identity.

Defined results: repeated rows are all returned and count once in the fit; null ids stay; ties of eigenvalues keep the order of
the rotation; components whose eigenvalue is below ``RANK`` of the trace are not given (none if all vectors are equal); an empty
table gives no rows. Vectors of another length than the commonest (of equals the longer) have no place in the space and are
left out, unless ``dim`` names the length. Scaled entries beyond ``BOUND`` count as the bound. A deviation beyond 64 bits is null. Only ``vec_id`` and
``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.common import stored, table

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
BOUND = 1 << 40
MOST_DIM = 1024  # the driver and each task hold a square matrix of this side at most (8 MB)
RANK = 1e-10
EXACT = float(1 << 52)
SUMS = "i int, j int, s decimal(38,0)"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) without missing or non-finite entries."""
    typed = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return typed.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(finite)


def common_length(vectors: DataFrame) -> int | None:
    counted = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    first = counted.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    return first[0]["dim"] if first else None


def scaled(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    """The entries as whole numbers, without the shift."""
    values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.clip(np.floor(scale * values), -BOUND, BOUND).astype(np.int64)


WIDTHS = ((np.dtype("<i1"), 1 << 7), (np.dtype("<i2"), 1 << 15), (np.dtype("<i4"), 1 << 31), (np.dtype("<i8"), 1 << 62))


def packed(x: np.ndarray) -> Iterator[pa.Array]:
    """Rows as bytes, in the narrowest integers that hold them; equal rows have equal bytes and different rows do not."""
    most, done = np.abs(x).max(axis=1, initial=0), np.zeros(len(x), dtype=bool)
    for kind, limit in WIDTHS:
        own = ~done & (most < limit)
        done |= own
        if own.any():
            size = kind.itemsize * x.shape[1]
            data = pa.py_buffer(np.ascontiguousarray(x[own].astype(kind)))
            yield pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), int(own.sum()), [None, data]).cast(pa.binary())


def unpacked(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for kind, _ in WIDTHS:
        own = column.filter(pa.array(sizes == kind.itemsize * dim))
        if len(own):
            yield np.frombuffer(b"".join(own.to_pylist()), dtype=kind).reshape(-1, dim).astype(np.int64)


def fit_list(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """x: the distinct vectors, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in packed(scaled(batch, dim, scale)):
                yield pa.RecordBatch.from_arrays([part], ["x"])

    return stored(vectors.select("embedding").mapInArrow(pack, "x binary").distinct())


def _sum_rows(entries: dict[tuple[int, int], int]) -> pa.RecordBatch:
    keys = list(entries)
    columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32())]
    columns.append(pa.array([Decimal(entries[k]) for k in keys], pa.decimal128(38, 0)))
    return pa.RecordBatch.from_arrays(columns, ["i", "j", "s"])


def _totals(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Sums by (i, j); as many rows reach the driver as a matrix has places."""
    return {(r["i"], r["j"]): int(r["s"]) for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}


def sums(fitted: DataFrame, dim: int) -> tuple[int, list[int]]:
    """n and the sums of the unshifted entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            for x in unpacked(batch.column("x"), dim):
                n += len(x)
                total = [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
        yield _sum_rows({(-1, -1): n, **{(-1, j): s for j, s in enumerate(total)}} if n else {})

    found = _totals(fitted.mapInArrow(add, SUMS))
    return found.get((-1, -1), 0), [found.get((-1, j), 0) for j in range(dim)]


def products(z: np.ndarray) -> np.ndarray:
    """z'z in whole numbers: by doubles or 64-bit integers while these are exact, else by Python's."""
    most = float(np.abs(z).max(initial=0))
    if most * most * len(z) < EXACT:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    return z.T.astype(object) @ z.astype(object)


def covariance(fitted: DataFrame, n: int, center: np.ndarray, rest: list[int]) -> np.ndarray:
    """The exact covariance, each entry rounded once. ``center`` are the whole numbers next to the mean, ``rest`` is S - n * center."""
    dim = len(center)
    upper = np.triu_indices(dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), dtype=object)
        for batch in batches:
            for x in unpacked(batch.column("x"), dim):
                total = total + products(x - center)
        i, j = upper
        yield _sum_rows({(a, b): int(s) for a, b, s in zip(i.tolist(), j.tolist(), total[upper], strict=True) if s})

    found = _totals(fitted.mapInArrow(add, SUMS))
    v = np.zeros((dim, dim))
    for i, j in zip(*upper, strict=True):
        v[i, j] = v[j, i] = (n * found.get((int(i), int(j)), 0) - rest[i] * rest[j]) / (n * n)
    return v


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (rows in pivot order, as many columns as the rank) and the order, with v[order][:, order] = L L'."""
    d = len(v)
    rest, order, low = v.copy(), np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * np.diag(v).max(initial=0)
    for k in range(d):
        p = k + int(np.argmax(np.diag(rest)[k:]))
        if rest[p, p] <= least:
            return low[:, :k], order
        for swapped in (rest, rest.T, low, order):
            swapped[[k, p]] = swapped[[p, k]]
        low[k, k] = np.sqrt(rest[k, k])
        low[k + 1 :, k] = rest[k + 1 :, k] / low[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return low, order


def one_sided_jacobi(low: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """``low`` times rotations, with orthogonal columns. A round rotates disjoint pairs of columns at once."""
    a, r = low.copy(), low.shape[1]
    ring = list(range(r)) + ([-1] if r % 2 else [])
    rounds = []
    for _ in range(len(ring) - 1):  # every pair once, by turning all but the first
        pairs = [(x, y) for x, y in zip(ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1], strict=True) if x >= 0 and y >= 0]
        if pairs:
            rounds.append(tuple(np.array(side) for side in zip(*pairs, strict=True)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            left, right = a[:, p], a[:, q]
            alpha, beta, gamma = (np.einsum("ij,ij->j", x, y) for x, y in ((left, left), (right, right), (left, right)))
            off = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, off.max())
            turn = off > np.finfo(float).eps
            zeta = np.where(turn, (beta - alpha) / np.where(turn, 2 * gamma, 1), 0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            a[:, p], a[:, q] = c * left - c * t * right, c * t * left + c * right
        if worst <= 8 * np.finfo(float).eps:
            break
    return a


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; only those above ``RANK`` of the trace."""
    low, order = pivoted_cholesky(v)
    rotated = one_sided_jacobi(low) if low.shape[1] else low
    lengths = np.sqrt(np.einsum("ij,ij->j", rotated, rotated))
    by_size = np.argsort(-lengths, kind="stable")
    by_size = by_size[lengths[by_size] ** 2 > RANK * np.trace(v)]
    components = np.zeros((len(v), len(by_size)))
    components[order] = rotated[:, by_size] / lengths[by_size]
    largest = np.abs(components).argmax(axis=0)
    signs = np.sign(components[largest, np.arange(len(by_size))])
    return lengths[by_size] ** 2, components * signs


@dataclass(frozen=True)
class Whitener:
    """What a fit found: n, the center as whole numbers (unshifted) with its rest, eigenvalues, components and the trace."""

    n: int
    center: np.ndarray
    rest: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    scale: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.center) - np.array([t / self.n for t in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        z, rest = x - self.center, np.array(self.rest, dtype=object)
        largest = float(self.n) * float(np.abs(z).max(initial=0)) + float(np.abs(rest).max(initial=0))
        if largest * largest * x.shape[1] < float(1 << 62):
            apart = self.n * z - rest.astype(np.int64)
            return np.einsum("ij,ij->i", apart, apart).tolist()
        exact = [sum((self.n * a - t) ** 2 for a, t in zip(row, self.rest, strict=True)) for row in z.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def fit(fitted: DataFrame, dim: int, components: int, scale: int) -> Whitener | None:
    if dim > MOST_DIM:
        raise ValueError(f"vectors of at most {MOST_DIM} entries, got {dim}")
    n, total = sums(fitted, dim)
    if not n:
        return None
    middle = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * m for s, m in zip(total, middle, strict=True)]
    center = np.array(middle, dtype=np.int64)
    v = covariance(fitted, n, center, rest)
    values, directions = eigen(v)
    return Whitener(n, center, rest, values[:components], directions[:, :components], float(np.trace(v)), scale)


def identity_error(fitted: DataFrame, whitener: Whitener) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    dim, k = whitener.components.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))  # the last row holds plain sums
        for batch in batches:
            for x in unpacked(batch.column("x"), dim):
                w = whitener.whitened(x)
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.indices(total.shape).reshape(2, -1)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "s"])

    total = np.zeros((k + 1, k))
    for r in fitted.mapInArrow(add, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r["i"], r["j"]] = r["s"]
    mean = total[k] / whitener.n
    return float(np.abs(total[:k] / whitener.n - np.outer(mean, mean) - np.eye(k)).max(initial=0))


SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, dim: int | None = None) -> DataFrame:
    """One row for each vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    vectors = usable(embeddings)
    dim = common_length(vectors) if dim is None else dim
    nothing = embeddings.sparkSession.createDataFrame([], SCHEMA)
    if dim is None:
        return nothing
    vectors = vectors.where(F.size("embedding") == dim)
    fitted = fit_list(vectors, dim, scale)
    whitener = fit(fitted, dim, components, scale)
    if whitener is None or not len(whitener.values):
        return nothing
    error, k = identity_error(fitted, whitener), len(whitener.values)
    explained = whitener.values / whitener.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(batch, dim, scale)
            rows = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column("vec_id").take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(rows), whitener.n)),
                pa.array(whitener.deviations(x), pa.int64()).take(pa.array(rows)),
                pa.array(whitener.whitened(x).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(project, SCHEMA)


def op11_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
