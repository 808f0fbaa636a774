"""Whitening of embeddings: leading eigenvectors of their covariance by block Lanczos steps over distributed passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE, SHIFT = 64, 1_000_000
#: Rows turned into a matrix at a time.
ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """What `fit` learns: rows in the fit list, sums of its dimensions, eigenvectors as columns, eigenvalues, the trace, and the largest entry of the whitened covariance less the identity."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def finite(vector: Column) -> Column:
    """Whether an array has neither null nor non-finite entries; false for null."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))


def matrices(batch, column: int, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows by d matrix of longs) of pieces of an Arrow batch whose column holds lists of d longs."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.column(column).slice(at, ROWS)
        yield at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: as longs, or where these don't reach as Python integers."""
    most = max(int(np.abs(x).max(initial=0)) * n, 0) + max((abs(int(s)) for s in sums), default=0)
    if most < 1 << 62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums.astype(object)


def _totals(d: int):
    """A task's rows, and the exact sum of each dimension."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, total = 0, [0] * d
        for b in batches:
            for _, x in matrices(b, 0, d):
                n += len(x)
                total = [a + int(s) for a, s in zip(total, (x if np.abs(x).max(initial=0) < 1 << 50 else x.astype(object)).sum(axis=0), strict=True)]
        from decimal import Decimal

        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d, dtype=np.int32)), pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))], ["at", "value"])

    return run


def _products(q: np.ndarray, n: int, sums: np.ndarray):
    """A task's share of n times the covariance times q, row by row; at -1 the sum of squared deviations over n squared."""
    d, b = q.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, square = np.zeros((d, b)), 0.0
        for batch in batches:
            for _, x in matrices(batch, 0, d):
                c = centred(x, n, sums).astype(np.float64) / n
                total += c.T @ (c @ q)
                square += float((c * c).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d * b, dtype=np.int32)), pa.array(np.concatenate([[square], total.ravel()]))], ["at", "value"])

    return run


def _summed(rows: DataFrame, kind: str, size: int) -> list:
    """The sums of each place over all tasks' rows, by place; nothing else goes to the driver."""
    out = [0] * size
    for at, value in rows.groupBy("at").agg(F.sum("value").cast(kind).alias("value")).collect():
        out[at + 1] = value
    return out


def _fresh(basis: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """`count` random unit columns orthogonal to the basis and to one another."""
    z = rng.standard_normal((basis.shape[0], count))
    for _ in range(3):
        z -= basis @ (basis.T @ z)
        z = np.linalg.qr(z)[0]
    return z


def block_lanczos(multiply: Callable[[np.ndarray], np.ndarray], trace: Callable[[], float], d: int, wanted: int, block: int, tolerance: float, seed: int = 20240701) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the `wanted` largest eigenpairs of a covariance, d by d, known through `multiply` and its trace alone.

    Each step multiplies one block of columns, then takes the whole basis out of the product, twice (full
    reorthogonalisation). What is left, factored, is the next block, and couples it to this one. Where it has lost rank (a
    breakdown: the space reached is invariant), random columns orthogonal to the basis go on in its place, uncoupled. It ends
    when the residual of each wanted pair, the coupling times the last rows of its coordinates, is below the tolerance times
    the largest value, or when the basis spans everything. After a breakdown no residual tells of values outside the space
    reached (of one repeated more often than a block has columns), so what the basis leaves of the trace must then be
    below the smallest wanted value too: no value outside is larger. The basis never holds more than d columns.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, d)
    basis = np.zeros((d, 0))
    q = _fresh(basis, min(block, d), rng)
    small = np.zeros((0, 0))  # the matrix in the basis
    broken = False
    while True:
        w = multiply(q)
        m, b = basis.shape[1], q.shape[1]
        basis = np.concatenate([basis, q], axis=1)
        own = q.T @ w
        small = np.pad(small, ((0, m + b - small.shape[0]),) * 2)
        small[m:, m:] = (own + own.T) / 2
        values, at = np.linalg.eigh(small)
        values, at = values[::-1], at[:, ::-1]
        left = d - basis.shape[1]
        if not left:
            break
        for _ in range(2):
            w = w - basis @ (basis.T @ w)
        u, s, _ = np.linalg.svd(w, full_matrices=False)
        scale = max(abs(values[0]), np.finfo(float).tiny)
        alive = min(int((s > 1e-13 * scale).sum()), left)
        q = u[:, :alive]
        for _ in range(2):  # a small rest is mostly rounding, and then not orthogonal yet
            q = np.linalg.qr(q - basis @ (basis.T @ q))[0]
        coupling = q.T @ w
        broken |= alive < min(b, left)
        residual = np.linalg.norm(coupling @ at[m:, :wanted], axis=0).max(initial=0)
        if basis.shape[1] >= wanted and residual <= tolerance * scale and (not broken or trace() - np.trace(small) <= max(values[wanted - 1], 1e-13 * scale * d)):
            break
        if alive < min(b, left):
            q = np.concatenate([q, _fresh(np.concatenate([basis, q], axis=1), min(b, left) - alive, rng)], axis=1)
        grown = np.pad(small, ((0, q.shape[1]),) * 2)
        grown[m + b : m + b + alive, m : m + b] = coupling
        grown[m : m + b, m + b : m + b + alive] = coupling.T
        small = grown
    return values[:wanted], basis @ at[:, :wanted]


def integers(vector: Column) -> Column:
    """Entries c, as doubles, as floor(SCALE * c) + SHIFT."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)


def dimensions(rows: DataFrame, vector: str) -> int:
    """The commonest length of the usable vectors, of equals the larger; 0 without rows."""
    sized = rows.where(finite(F.col(vector))).groupBy(F.size(vector).alias("d")).count()
    first = sized.orderBy(F.desc("count"), F.desc("d")).first()
    return first[0] if first else 0


def fit(rows: DataFrame, vector: str = "embedding", components: int = 16, block: int = 16, tolerance: float = 1e-14) -> Whitening | None:
    """The whitening of the distinct integer vectors of rows, each once; None without a usable vector or without entries in them.

    Distinct vectors are written once to the shared folder; each step is a pass over them in which a task adds up its
    share of the product, d times `block` numbers, that are summed in a shuffle. d times `block` sums and the basis, d
    by d at most, are all that the driver holds. A last pass multiplies the vectors found: it gives identity_error.
    """
    d = dimensions(rows, vector)
    if not d:
        return None
    spark = rows.sparkSession
    common.ship(spark)
    with common.scratch(spark):
        usable = rows.where(finite(F.col(vector)) & (F.size(vector) == d))
        fitted = common.materialize(usable.select(integers(F.col(vector)).alias("x")).distinct(), "fitlist")
        n, *sums = (int(v) for v in _summed(fitted.mapInArrow(_totals(d), "at int, value decimal(38,0)"), "decimal(38,0)", d + 1))
        sums = np.array(sums, object)
        squares = [0.0]

        def multiply(q: np.ndarray) -> np.ndarray:
            got = _summed(fitted.mapInArrow(_products(q, n, sums), "at int, value double"), "double", q.size + 1)
            squares[0] = got[0]
            return np.array(got[1:]).reshape(q.shape) / n

        values, vectors = block_lanczos(multiply, lambda: squares[0] / n, d, components, block, tolerance)
        kept = values > max(values.max(initial=0), 0) * d * np.finfo(float).eps
        values, vectors = values[kept], vectors[:, kept]
        over = 1 / np.sqrt(values)
        error = float(np.abs(over[:, None] * (vectors.T @ multiply(vectors)) * over - np.eye(len(values))).max(initial=0)) if len(values) else 0.0
    return Whitening(n, sums, vectors, values, squares[0] / n, error)


def _project(model: Whitening):
    d = len(model.sums)
    to = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            deviations, rows = [np.zeros(0, np.int64)], [np.zeros((0, to.shape[1]))]
            for _, x in matrices(b, 1, d):
                c = centred(x, model.n, model.sums)
                if c.dtype == object or d * int(np.abs(c).max(initial=0)) ** 2 >= 1 << 63:
                    square = (c.astype(object) ** 2).sum(axis=1)
                    if max(square) >= 1 << 63:
                        raise OverflowError("a vector's deviation doesn't fit in a long")
                    square = square.astype(np.int64)
                else:
                    square = (c * c).sum(axis=1)
                deviations.append(square)
                rows.append((c.astype(np.float64) / model.n) @ to)
            flat = np.concatenate(rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(deviations)), lists], ["key", "deviation", "whitened"])

    return run


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16, model: Whitening | None = None) -> DataFrame:
    """key, component (int, from 1 by falling eigenvalue), n, deviation, whitened, explained, identity_error of each usable row.

    Usable rows: vectors that are not null, hold no null or non-finite entry, and have the commonest length (of equals the
    larger). Null keys stay null; repeated rows are returned each, and count once in the fit. An entry whose integer no long holds is an error. Components without variance
    (of a single vector, say) are left out, so there may be fewer rows than `components` for a vector. A deviation that no
    long holds is an error. No usable rows: no rows. Other columns are ignored, whatever their names.
    """
    model = model or fit(rows, vector, components)
    kind = rows.schema[key].dataType.simpleString()
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    common.ship(rows.sparkSession)
    usable = rows.where(finite(F.col(vector)) & (F.size(vector) == len(model.sums)))
    out = usable.select(F.col(key).alias("key"), integers(F.col(vector)).alias("x")).mapInArrow(_project(model), f"key {kind}, deviation long, whitened array<double>")
    each = out.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.get(F.array(*[F.lit(float(v / model.trace)) for v in model.values]), F.col("at"))
    return each.select(F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
