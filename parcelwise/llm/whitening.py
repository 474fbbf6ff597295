"""Whitening of embeddings; components by QDWH spectral divide and conquer of the covariance.

1. Vectors become integers, floor(`scale` * entry) + `shift`, so their sums are exact in any order.
2. The covariance is summed per partition from centred values; what leaves a task is one matrix, dealt out
   and added row by row, so the driver holds one matrix of the vectors' dimension and no vector.
3. The matrix is split. The polar factor U of the matrix less a shift has eigenvalue 1 on the components
   above the shift and -1 on those below; (U + 1) / 2 is the spectral projector. An orthonormal basis of
   its range and one of the rest turn the matrix into two blocks, which are split in turn until single
   components are left. U comes from the QR-based dynamically weighted Halley iteration, which needs
   about six products whatever the shift. Last steps of refinement take the basis to double precision.
4. The components are broadcast (dimension times number of components) and rows are projected where they are.

`identity_error` is measured on the whitened rows themselves by one more pass of the same kind.

Defined cases: rows with a null vector, a null or non-finite entry are dropped; vectors of another length
than most have (of equally frequent lengths the shortest counts) are dropped as well; entries beyond
2^53 / `scale` are refused with an error, as they have no exact integer, and so is a deviation beyond 64
bits; directions without variance (an eigenvalue not above rounding of the largest) are no components, so
equal vectors, a single one or an empty table give no rows; repeated rows and ids count as often as they
come; the order within equal eigenvalues is arbitrary but the same for all rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley steps.

    `low` bounds the least singular value of the iterate from below. A singular matrix keeps the
    directions without a sign near zero; the caller looks for them."""
    size = len(a)
    x = a / np.linalg.norm(a)
    low = EPS
    for _ in range(12):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        first = np.sqrt(1 + d)
        weight = first + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * first))
        second = (weight - 1) ** 2 / 4
        third = weight + second - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(third) * x, np.eye(size))))
        after = second / third * x + (weight - second / third) / np.sqrt(third) * (q[:size] @ q[size:].T)
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (weight + second * square) / (1 + third * square))
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS) / 100:
            break
    return x


def _bases(projector: np.ndarray, rank: int, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal basis of the projector's range, then of the rest; the range of a random mixture is improved once."""
    size = len(projector)
    own, _ = np.linalg.qr(projector @ rng.standard_normal((size, rank)))
    q, _ = np.linalg.qr(np.hstack((projector @ own, (np.eye(size) - projector) @ rng.standard_normal((size, size - rank)))))
    return q


def components(matrix: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix."""
    rng = np.random.default_rng(seed)
    scale = np.linalg.norm(matrix)
    basis = np.eye(len(matrix))
    todo = [(0, len(matrix))] if scale else []
    while todo:
        start, end = todo.pop()
        own = basis[:, start:end]
        block = own.T @ matrix @ own
        block = (block + block.T) / 2
        diagonal = np.diag(block)
        if end - start < 2 or np.linalg.norm(block - np.diag(diagonal)) <= EPS * scale:
            continue
        spread = np.linalg.norm(block - diagonal.mean() * np.eye(end - start))
        # The mean parts any block that is no multiple of the identity; the median parts it more evenly.
        for cut in (np.median(diagonal), diagonal.mean(), *(diagonal.mean() + spread * rng.uniform(-0.05, 0.05, 6))):
            u = polar(block - cut * np.eye(end - start)) if spread > EPS * scale else np.eye(end - start)
            rank = int(round((np.trace(u) + end - start) / 2))
            clear = np.linalg.norm(u @ u - np.eye(end - start)) < 1e-10 * (end - start)
            if clear and 0 < rank < end - start:
                basis[:, start:end] = own @ _bases((u + np.eye(end - start)) / 2, rank, rng)
                todo += [(start, start + rank), (start + rank, end)]
                break
    return _refined(matrix, basis)


def _refined(matrix: np.ndarray, basis: np.ndarray, steps: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Newton steps for the whole basis: what is left beside the diagonal and of the basis's lack of orthogonality is
    taken out; between nearly equal eigenvalues only the latter."""
    scale = max(np.linalg.norm(matrix), np.finfo(float).tiny)
    for _ in range(steps):
        lack = np.eye(len(matrix)) - basis.T @ basis
        turned = basis.T @ matrix @ basis
        values = np.diag(turned) / (1 - np.diag(lack))
        off = turned + lack * values
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > 1e-9 * scale
        change = np.where(apart, off / np.where(apart, gap, 1), lack / 2)
        np.fill_diagonal(change, np.diag(lack) / 2)
        basis = basis + basis @ change
    basis, r = np.linalg.qr(basis)
    basis = basis * np.where(np.diag(r) < 0, -1.0, 1.0)
    values = np.einsum("ij,ij->j", basis, matrix @ basis)
    order = np.argsort(-values, kind="stable")
    return values[order], basis[:, order]


def _integers(vectors: pa.Array, scale: int, shift: int) -> np.ndarray:
    width = len(vectors.flatten()) // max(1, len(vectors))
    entries = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(float))
    if len(entries) and np.abs(entries).max() >= 2**53:
        raise ValueError("an entry is too large for an exact integer")
    return entries.astype(np.int64).reshape(-1, width) + shift


def usable(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of rows with a vector of finite entries and of the most frequent length."""
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & ~odd)
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("vector") == (lengths.d if lengths else 0))


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str, scale: int, shift: int) -> np.ndarray | None:
    """Sum of a matrix per partition, `part` of its integer vectors, over all partitions; added row by row."""
    values = pa.int64() if kind == "long" else pa.float64()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(_integers(batch.column(0), scale, shift))
                total = own if total is None else total + own
        if total is not None:
            cells = [np.repeat(np.arange(total.shape[0]), total.shape[1]), np.tile(np.arange(total.shape[1]), total.shape[0])]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in cells), pa.array(total.ravel(), values)], ["i", "j", "x"]
            )

    found = rows.select("vector").mapInArrow(sums, f"i int, j int, x {kind}").groupBy("i", "j").agg(F.sum("x").alias("x"))
    cells = found.toArrow()
    if not len(cells):
        return None
    i, j, x = (cells.column(c).to_numpy() for c in ("i", "j", "x"))
    out = np.zeros((i.max() + 1, j.max() + 1), x.dtype)
    out[i, j] = x
    return out


@dataclass
class Whitening:
    """What rows are projected with: n vectors with sums S, and per component a direction over its deviation."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    projection: np.ndarray
    total: float
    scale: int
    shift: int

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.projection

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the whole part of the mean is taken off in integers."""
        whole = self.sums // self.n
        return (x - whole) - (self.sums - whole * self.n) / self.n


def fit(rows: DataFrame, count: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Whitening of all `rows` (vector), or None where no direction has variance."""
    sums = _summed(rows, lambda x: np.vstack((np.append(x.sum(axis=0), len(x)),)), "long", scale, shift)
    if sums is None or sums.shape[1] < 2:
        return None
    n, sums = int(sums[0, -1]), sums[0, :-1]
    centre = Whitening(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0, scale, shift)

    def products(x: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        return c.T @ c

    covariance = _summed(rows, products, "double", scale, shift) / n
    values, vectors = components((covariance + covariance.T) / 2)
    kept = [k for k in range(min(count, len(values))) if values[k] > len(values) * EPS * max(values[0], 0)]
    if not kept:
        return None
    projection = vectors[:, kept] / np.sqrt(values[kept])
    return Whitening(n, sums, values[kept], projection, float(np.trace(covariance)), scale, shift)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""

    def products(x: np.ndarray) -> np.ndarray:
        y = model.project(x)
        return np.vstack((y.T @ y, y.sum(axis=0)))

    found = _summed(rows, products, "double", model.scale, model.shift) / model.n
    mean = found[-1]
    return float(np.abs(found[:-1] - np.outer(mean, mean) - np.eye(len(mean))).max())


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """`rows` (vec_id, vector) with `deviation` and the array `whitened`."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def project(vectors: pa.Array) -> pa.Array:
        own = shared.value
        if not len(vectors):
            return pa.array([], pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]))
        x = _integers(vectors, own.scale, own.shift)
        apart = own.n * x - own.sums
        if (apart.astype(float) ** 2).sum(axis=1).max() > 2.0**62:
            exact = [sum(int(v) ** 2 for v in row) for row in own.n * x.astype(object) - own.sums]
            if max(exact) >= 2**63:
                raise ValueError("a deviation is beyond 64 bits")
        else:
            exact = (apart**2).sum(axis=1)
        y = own.project(x)
        ends = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
        whitened = pa.ListArray.from_arrays(ends, pa.array(y.ravel()))
        return pa.StructArray.from_arrays([pa.array(exact, pa.int64()), whitened], ["deviation", "whitened"])

    projected = F.arrow_udf(project, "struct<deviation:long,whitened:array<double>>")
    return rows.select("vec_id", projected("vector").alias("p")).select("vec_id", "p.*")


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whitened_rows(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    count: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error per usable row and component."""
    rows = usable(embeddings, vec_id, vector)
    model = fit(rows, count, scale, shift)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    error = identity_error(rows, model)
    shares = F.array(*[F.lit(float(v / model.total)) for v in model.values])
    out = apply(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
