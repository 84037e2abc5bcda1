"""Embedding whitening by QDWH spectral divide and conquer.

Every entry c of an embedding becomes the whole number x = floor(64 c) + 1000000.
Mean and covariance are taken over the distinct x vectors, the fit list; sums
and products of whole numbers are exact, so they do not depend on how the rows
are spread. The covariance is centred by each dimension's rounded mean before
anything is multiplied, and the remainder of the mean is taken off exactly.

Components: the polar decomposition of the covariance less a shift, by dynamically
weighted Halley iterations (QDWH), has the signs of the shifted eigenvalues, and
so gives the projector on the eigenvectors above the shift. Bases of its range
and of the rest split the matrix in two blocks, which are split again, down to
single eigenvalues. The matrix has a row per dimension, whatever the number of
embeddings, and is divided on the driver. Whitening broadcasts it.

Defined results: an embedding that is null or empty, or holds a null, NaN, infinity or an
entry of 2**40 or more in size, is dropped. So are those whose length is not the
most common one (of equally common ones the greatest). Repeated rows stay, each
with its own results, and count once in the fit. A component whose eigenvalue is
zero (below 1e-13 of the largest, as rounding leaves it) has no whitened values
and is left out: one distinct vector, or an empty table, gives no rows. A deviation
beyond 64 bits is null. Of equal eigenvalues any orthonormal basis may serve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.tables import quoted, read, ready_for_python
from plantloom.session import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LARGEST = 2.0 ** 40
# Eigenvalues below this share of the largest count as zero.
ZERO = 1e-13
EPS = np.finfo(float).eps
LONG = 2 ** 63 - 1


# ---- spectral divide and conquer ---------------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its eigenvalues' signs.

    QDWH: a Halley iteration whose weights follow from a lower bound for the
    smallest singular value; by QR while that is small, then by Cholesky.
    """
    size = len(a)
    norm = np.linalg.norm(a)
    if norm == 0:
        return np.eye(size)
    x, low = a / norm, EPS
    for _ in range(60):
        d = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(size)]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:size] @ q[size:].T
        else:
            z = np.linalg.cholesky(np.eye(size) + wc * x.T @ x)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z.T, np.linalg.solve(z, x.T)).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if moved < np.cbrt(EPS) * 1e-3 and 1 - low < 1e-8:
            break
    return x


def _range_basis(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of the rest."""
    order = np.argsort(-np.einsum("ij,ij->j", projector, projector), kind="stable")
    basis, chosen = np.empty((len(projector), 0)), projector[:, order].copy()
    # pivoted Gram-Schmidt picks independent columns, a second pass makes them orthogonal
    for _ in range(rank):
        v = chosen[:, np.argmax(np.einsum("ij,ij->j", chosen, chosen))]
        v = v - basis @ (basis.T @ v)
        v = projector @ (v / np.linalg.norm(v))
        v = v - basis @ (basis.T @ v)
        basis = np.column_stack([basis, v / np.linalg.norm(v)])
        chosen = chosen - np.outer(basis[:, -1], basis[:, -1] @ chosen)
    whole, _ = np.linalg.qr(np.column_stack([basis, np.eye(len(projector))]))
    return whole[:, :rank], whole[:, rank:]


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Where to cut: middles of the diagonal first, which lies within the spectrum's bounds."""
    diagonal = np.sort(np.diag(a))
    low, high = diagonal[0], diagonal[-1]
    yield (diagonal[(len(a) - 1) // 2] + diagonal[len(a) // 2]) / 2
    yield np.trace(a) / len(a)
    for k in range(1, 16):
        yield low + (high - low) * ((k * 0.6180339887498949) % 1)


def divide(a: np.ndarray, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and orthonormal eigenvectors (columns) of a symmetric matrix, in no order."""
    size = len(a)
    scale = np.linalg.norm(a) if scale is None else scale
    off = a - np.diag(np.diag(a))
    if size < 2 or np.linalg.norm(off) <= EPS * scale:
        return np.diag(a).copy(), np.eye(size)
    if size == 2:
        return _two(a)
    best = None
    for shift in _shifts(a):
        projector = (polar_factor(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < size:
            continue
        upper, lower = _range_basis(projector, rank)
        left_over = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left_over < best[0]:
            best = left_over, upper, lower
        # a shift on top of an eigenvalue leaves more than rounding; another one is tried then
        if left_over <= 10 * size * EPS * scale:
            break
    if best is None:
        # nothing to cut: equal eigenvalues, as far as rounding lets see
        return np.diag(a).copy(), np.eye(size)
    values, vectors = [], []
    for basis in best[1:]:
        block = basis.T @ a @ basis
        found, inner = divide((block + block.T) / 2, scale)
        values.append(found)
        vectors.append(basis @ inner)
    return np.concatenate(values), np.column_stack(vectors)


def _two(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest split in closed form: one rotation makes the block diagonal."""
    angle = 0.5 * np.arctan2(2 * a[0, 1], a[0, 0] - a[1, 1])
    c, s = np.cos(angle), np.sin(angle)
    turn = np.array([[c, -s], [s, c]])
    return np.diag(turn.T @ a @ turn).copy(), turn


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix."""
    if not len(a):
        return np.empty(0), np.empty((0, 0))
    _, vectors = divide(a)
    # what the splits rounded off: once more in the found basis, whose matrix is all but diagonal
    vectors, _ = np.linalg.qr(vectors)
    inner = vectors.T @ a @ vectors
    values, turn = divide((inner + inner.T) / 2)
    order = np.argsort(-values, kind="stable")
    return values[order], (vectors @ turn)[:, order]


# ---- fit and whitening -------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """What a fit found: exact sums, eigenvalues (falling) and components (columns)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """Each dimension's mean, rounded: a whole number to subtract without rounding."""
        return np.array([_rounded(s, self.n) for s in self.sums], np.int64)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole-number vectors."""
        centre = self.centre
        rest = np.array([float(Fraction(s - int(c) * self.n, self.n))
                         for s, c in zip(self.sums, centre)])
        return ((x - centre) - rest) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n x - S)**2; None beyond 64 bits."""
        if not len(x):
            return []
        centre = self.centre
        z, rest = x - centre, [s - int(c) * self.n for s, c in zip(self.sums, centre)]
        most = self.n * int(np.abs(z).max()) + max(map(abs, rest))
        if most * most * x.shape[1] <= LONG:
            y = self.n * z - np.array(rest, np.int64)
            return [int(v) for v in (y * y).sum(axis=1)]
        exact = (sum((self.n * int(c) - r) ** 2 for c, r in zip(row, rest)) for row in z)
        return [v if v <= LONG else None for v in exact]


def _rounded(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows that count, with their whole-number vector as ``x`` beside all columns as ``row``."""
    value = quoted(column)
    kept = vectors.select(F.struct(*[quoted(c) for c in vectors.columns]).alias("row"),
                          value.cast("array<double>").alias("v")).filter(
        (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < LARGEST)))
    length = kept.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.max_by("dims", F.struct("n", "dims")).alias("dims")).first().dims
    return kept.filter(F.size("v") == F.lit(length or 0)).select(
        "row", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(OFFSET)).alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(rows, -1)


def _gram(z: np.ndarray) -> np.ndarray:
    """Exact z'z as Python integers."""
    most, total = int(np.abs(z).max(initial=0)), np.zeros((z.shape[1],) * 2, object)
    if most * most >= 2 ** 53:
        return z.astype(object).T @ z.astype(object)
    # doubles hold every partial sum of a block without rounding
    step = max(1, 2 ** 53 // max(1, most * most))
    for at in range(0, len(z), step):
        block = z[at:at + step].astype(float)
        total += (block.T @ block).astype(np.int64).astype(object)
    return total


def fit(x: DataFrame, components: int | None = None) -> Whitening:
    """Mean, covariance and components of the distinct vectors ``x`` (array<long>).

    Tasks add up a row per dimension; these are summed in shuffles, and what
    reaches the driver has a row per dimension.
    """
    ready_for_python(x.sparkSession)
    distinct = materialize(x.select("x").distinct())

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                part = _matrix(batch.column(0), batch.num_rows)
                n += len(part)
                part = part.astype(object).sum(axis=0) if np.abs(part).max(initial=0) >= 2 ** 40 else part.sum(axis=0)
                total = part.astype(object) if total is None else total + part.astype(object)
        if n:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(len(total)), pa.int32()), "n": pa.array([n] * len(total), pa.int64()),
                "s": pa.array([str(v) for v in total])})

    exact = "decimal(38,0)"
    sums = distinct.mapInArrow(add_up, "i int, n long, s string").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast(exact)).alias("s")).collect()
    if not sums:
        return Whitening(0, (), np.empty(0), np.empty((0, 0)), 0.0)
    n = sums[0].n
    sums = tuple(int(r.s) for r in sorted(sums, key=lambda r: r.i))
    centre = np.array([_rounded(s, n) for s in sums], np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = _gram(_matrix(batch.column(0), batch.num_rows) - centre)
                total = part if total is None else total + part
        if total is not None:
            for i, row in enumerate(total):
                yield pa.RecordBatch.from_pydict({
                    "i": pa.array([i] * (i + 1), pa.int32()), "j": pa.array(range(i + 1), pa.int32()),
                    "s": pa.array([str(v) for v in row[:i + 1]])})

    products = distinct.mapInArrow(multiply, "i int, j int, s string").groupBy("i", "j").agg(
        F.sum(F.col("s").cast(exact)).alias("s")).collect()
    rest = [s - int(c) * n for s, c in zip(sums, centre)]
    cov = np.zeros((len(sums),) * 2)
    for r in products:
        cov[r.i, r.j] = cov[r.j, r.i] = float(Fraction(n * int(r.s) - rest[r.i] * rest[r.j], n * n))
    values, vectors = spectrum(cov)
    trace = float(np.trace(cov))
    some = values > ZERO * max(values.max(initial=0.0), 0.0)
    kept = np.flatnonzero(some)[:components]
    return Whitening(n, sums, values[kept], vectors[:, kept], trace)


def identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the whitened fit list's covariance minus the identity."""
    size = len(model.values)
    if not size:
        return 0.0
    shared = x.sparkSession.sparkContext.broadcast(model)  # a row per dimension

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, total = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                w = shared.value.project(_matrix(batch.column(0), batch.num_rows))
                mean, total = mean + w.sum(axis=0), total + w.T @ w
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(range(size), pa.int32()), "m": pa.array(mean),
            "row": pa.array(list(total), pa.list_(pa.float64()))})

    sums = x.select("x").distinct().mapInArrow(multiply, "i int, m double, row array<double>").select(
        "i", "m", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(
        F.sum("m").alias("m"), F.sum("v").alias("v")).collect()
    mean, cov = np.zeros(size), np.zeros((size, size))
    for r in sums:
        mean[r.i], cov[r.i, r.j] = r.m / model.n, r.v / model.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(size)).max())


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` of ``whole_numbers`` with ``whitened`` (a value per component) and ``deviation``."""
    ready_for_python(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # a row per dimension

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), batch.num_rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row"), pa.array(shared.value.deviations(x), pa.int64()),
                    pa.array(list(shared.value.project(x)), pa.list_(pa.float64()))],
                    names=["row", "deviation", "whitened"])

    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(apply, f"row {row}, deviation long, whitened array<double>")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first components of all distinct ones."""
    rows = materialize(whole_numbers(read(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select(
        F.struct("row.vec_id").alias("row"), "x"))
    model = fit(rows, COMPONENTS)
    error = identity_error(rows, model)
    share = spark.createDataFrame(
        [(i + 1, float(v / model.trace)) for i, v in enumerate(model.values)],
        "component int, explained double")
    found = whitened(rows, model).select(
        "row.vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    # a row per component
    return found.join(F.broadcast(share), F.col("place") + 1 == F.col("component")).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        "explained", F.lit(error).alias("identity_error"))
