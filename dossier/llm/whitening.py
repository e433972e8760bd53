"""Embedding whitening: principal axes by LOBPCG, then projection and scaling of every row.

An entry c becomes the whole number x = floor(64 * c) + 1000000, so sums, means and deviations are exact. The fit list holds
each distinct x vector once. Its covariance V is never built: a step needs V times a block of columns, and a task returns
sum over its rows of (x - mean) ((x - mean) block), one matrix of dimensions by columns; these are added up in a few tasks
and then on the driver. The block method (locally optimal block preconditioned conjugate gradients) then works on matrices
of dimensions by three times ``components + guard``: Rayleigh-Ritz on the iterate, its residuals, and the previous
directions, with an orthonormal basis, until every wanted residual |V u - e u| is at most ``TOLERANCE`` of the largest
eigenvalue. The residuals that end it are of a fresh product with the rows, not of the updated one.

Rows whose vector is null or empty, or holds null or non-finite entries, or entries whose 64-fold leaves +-2^52, are dropped.
Vectors of other lengths form fits of their own. Axes whose eigenvalue is at most ``RANK`` of the largest have no whitened
value: vectors of rank r give r components, equal vectors none. A sign is free; the largest entry of an axis is positive here.
Empty in, empty out. Other columns pass through, but for those named as the ones added. RuntimeError if residuals don't get
there in ``STEPS`` steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.shared import cut, quoted, table, unused

ADDED = ("n", "deviation", "whitened", "explained", "identity_error")
TOLERANCE, RANK, STEPS, GUARD = 1e-12, 1e-10, 500, 8
#: Tasks that add up the matrices of all others.
ADDERS = 16
FINEST, SHIFT = 64, 1_000_000


def whole_numbers(vector: Column) -> Column:
    """array<long> of x; null where the row is dropped."""
    near = F.transform(vector, lambda c: c.cast("double") * FINEST)
    usable = (F.size(vector) > 0) & F.forall(near, lambda c: F.coalesce(F.abs(c) <= 2.0**52, F.lit(False)) & ~F.isnan(F.coalesce(c, F.lit(0.0))))
    return F.when(usable, F.transform(near, lambda c: F.floor(c) + SHIFT))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: in 64 bits where that is certain to fit, else in Python's numbers."""
    if len(x) and n * int(np.abs(x).max()) >= 2**61:
        return n * x.astype(object) - np.array(sums, object)
    return n * x - np.array(sums, np.int64)


def squares(of: np.ndarray) -> list | np.ndarray:
    """Sum of squares by row, exact."""
    if of.dtype == object or (of.size and of.shape[1] * int(np.abs(of).max()) ** 2 >= 2**63):
        return [sum(int(v) ** 2 for v in row) for row in of]
    return (of * of).sum(axis=1)


def _added(fit: DataFrame, shape: tuple[int, int], kind: type, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``part(x rows)``; tasks return one matrix each, ``ADDERS`` tasks add these."""

    def add(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, any_rows = np.zeros(shape, kind), False
        for block in blocks:
            total, any_rows = total + block, True
        if any_rows:
            yield pa.RecordBatch.from_pydict({"task": pa.array([TaskContext.get().partitionId()], pa.int32()), "block": pa.array([total.tobytes()], pa.binary())})

    def of_rows(batches):
        return add(part(_matrix(b.column(0), shape[0])) for b in batches if b.num_rows)

    def of_blocks(batches):
        return add(np.frombuffer(v.as_py(), kind).reshape(shape) for b in batches for v in b.column(1))

    schema = "task int, block binary"
    few = fit.mapInArrow(of_rows, schema).repartition(ADDERS, "task").mapInArrow(of_blocks, schema)
    return sum((np.frombuffer(bytes(r["block"]), kind).reshape(shape) for r in few.select("block").collect()), np.zeros(shape, kind))


def _sums(fit: DataFrame, d: int) -> list[int]:
    """Sum of x by dimension; high and low parts are added apart, so that neither leaves 64 bits."""
    both = _added(fit, (d, 2), np.int64, lambda x: np.stack([(x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0)], axis=1))
    return [(int(high) << 26) + int(low) for high, low in both]


def _joined_basis(held: np.ndarray, more: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns ``more`` add to the orthonormal ``held``."""
    for _ in range(2):
        more = more - held @ (held.T @ more)
        size = np.linalg.norm(more, axis=0)
        more = more[:, size > 0] / size[size > 0]
    if not more.shape[1]:
        return more
    left, strength, _ = np.linalg.svd(more, full_matrices=False)
    basis = left[:, strength > 1e-7 * strength[0]][:, : held.shape[0] - held.shape[1]]
    return np.linalg.qr(basis - held @ (held.T @ basis))[0]


def lobpcg(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, guard: int = GUARD, seed: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``wanted`` largest eigenvalues and unit eigenvectors (columns) of the symmetric d x d operator ``product``, and steps."""
    m = min(d, wanted + guard)
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, m)))[0]
    ax, directions = product(x), np.zeros((d, 0))
    basis = abasis = np.zeros((d, 0))
    for step in range(STEPS):
        whole, awhole = np.hstack([x, basis]), np.hstack([ax, abasis])
        small = whole.T @ awhole
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:m], turn[:, ::-1][:, :m]
        directions = basis @ turn[x.shape[1] :]
        x, ax = whole @ turn, awhole @ turn
        residual = ax - x * values
        size = np.linalg.norm(residual, axis=0)
        if (size[:wanted] <= TOLERANCE * abs(values[0])).all():
            ax = product(x)
            residual = ax - x * values
            size = np.linalg.norm(residual, axis=0)
            if (size[:wanted] <= TOLERANCE * abs(values[0])).all():
                return values[:wanted], x[:, :wanted], step
        basis = _joined_basis(x, np.hstack([residual[:, size > 0], directions]))
        abasis = product(basis) if basis.shape[1] else basis
    raise RuntimeError(f"residuals of {wanted} components did not settle in {STEPS} steps")


@dataclass
class Axes:
    """A fit of vectors of one length: list size, sums by dimension, axes as columns, eigenvalues, total variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0
    steps: int = 0

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - sums and the whitened values of ``x`` rows."""
        exact = scaled(x, self.n, self.sums)
        return exact, (exact / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))


def _fit_length(fit: DataFrame, d: int, n: int, wanted: int) -> Axes:
    sums = _sums(fit, d)
    centred = lambda x: (scaled(x, n, sums) / n).astype(np.float64)

    def product(block: np.ndarray) -> np.ndarray:
        def part(x):
            c = centred(x)
            return c.T @ (c @ block)

        return _added(fit, (d, block.shape[1]), np.float64, part) / n

    trace = float(_added(fit, (d, 1), np.float64, lambda x: (centred(x) ** 2).sum(axis=0)[:, None]).sum()) / n
    if trace <= 0:
        return Axes(n, sums, np.zeros((d, 0)), np.zeros(0), trace)
    values, vectors, steps = lobpcg(product, d, min(wanted, d))
    stay = values > RANK * values[0]
    values, vectors = values[stay], vectors[:, stay]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    axes, k = Axes(n, sums, vectors, values, trace, steps=steps), len(values)

    def moments(x):
        white = axes.project(x)[1]
        out = np.zeros((d, k + 1))  # the shape tells the rows' length; k is at most d
        out[:k, :k], out[:k, k] = white.T @ white, white.sum(axis=0)
        return out

    found = _added(fit, (d, k + 1), np.float64, moments)[:k] / n
    axes.identity_error = float(np.abs(found[:, :k] - np.outer(found[:, k], found[:, k]) - np.eye(k)).max())
    return axes


def fit_axes(rows: DataFrame, column: str = "embedding", components: int = 16) -> dict[int, Axes]:
    """Axes of the vectors in ``column``, by vector length."""
    x = whole_numbers(quoted(column)).alias("x")
    fit = cut(rows.select(x).where("x is not null").distinct(), "whitening-fit")
    lengths = {r["d"]: r["n"] for r in fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect()}
    return {d: _fit_length(fit.where(F.size("x") == d) if len(lengths) > 1 else fit, d, n, components) for d, n in sorted(lengths.items())}


def whiten(rows: DataFrame, column: str = "embedding", components: int = 16) -> DataFrame:
    """``rows`` that have a usable vector, with n and identity_error of its fit, deviation as decimal(38, 0) (sum over dimensions
    of (n * x - sum)^2, null where that has more digits), and by component whitened and explained as arrays."""
    names = [c for c in rows.columns if c.lower() not in ADDED]
    axes = fit_axes(rows, column, components)
    (x,) = unused(names, "_x")
    held = rows.select(*map(quoted, names), whole_numbers(quoted(column)).alias(x)).where(F.col(x).isNotNull())
    added = T.StructType().add("n", "long").add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType())).add("explained", T.ArrayType(T.DoubleType())).add("identity_error", "double")
    schema = T.StructType([f for f in held.schema.fields if f.name != x] + added.fields)

    def deviations(exact):
        found = squares(exact)
        if isinstance(found, np.ndarray):
            return pa.array(found, pa.int64()).cast(pa.decimal128(38, 0))
        from decimal import Decimal

        return pa.array([Decimal(v) if v < 10**38 else None for v in found], pa.decimal128(38, 0))

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column(x).value_lengths())
            for d in np.unique(lengths):
                own = batch if (lengths == d).all() else batch.take(pa.array(np.flatnonzero(lengths == d)))
                fit, count = axes[int(d)], own.num_rows
                exact, white = fit.project(_matrix(own.column(x), int(d)))
                k = len(fit.values)
                lists = lambda flat: pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * k, pa.int32()), pa.array(flat, pa.float64()))  # noqa: B023, E731
                made = [pa.array(np.full(count, fit.n), pa.int64()), deviations(exact), lists(white.ravel()), lists(np.tile(fit.values / fit.trace, count) if k else np.zeros(0)), pa.array(np.full(count, fit.identity_error))]
                yield pa.RecordBatch.from_arrays([own.column(c) for c in names] + made, names=names + list(ADDED))

    return held.mapInArrow(of_batch, schema)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    zipped = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "v")
    found = found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", zipped)
    return found.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "v.whitened", "v.explained", "identity_error")
