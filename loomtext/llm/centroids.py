"""Centroid clustering of integer vectors, exact, with Drake's bounds: most vectors keep their centroid without any distance computed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .whitening import finite, matrices

#: Rows worked on at a time.
ROWS = 4096
#: What covers the rounding of square roots and sums of bounds, as a factor.
SLACK = 1e-9
STATE = "id {kind}, x array<long>, cluster int, upper double, distance long, near array<int>, lower array<float>, rest float, used int, n long, inertia long, sums array<long>"


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids, as longs."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < 1 << 53:  # every sum is then exact in doubles
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    _fits(x.shape[1], most)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _fits(d: int, most: int) -> None:
    if d * (2 * most) ** 2 >= 1 << 63:
        raise OverflowError("a squared distance doesn't fit in a long")


def paired(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of x, rows by d, to its own centroids, rows by d or rows by several by d."""
    _fits(x.shape[-1], max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0))))
    differ = centroids - (x if centroids.ndim == 2 else x[:, None, :])
    return (differ * differ).sum(axis=-1)


def _below(distances: np.ndarray) -> np.ndarray:
    """Lower bounds in 32 bits: the distance, rounded down."""
    return np.nextafter((np.sqrt(distances) * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))


def _above(distances: np.ndarray) -> np.ndarray:
    return np.sqrt(distances) * (1 + SLACK)


class Bounds:
    """The state of some vectors: their centroid, an upper bound of the distance to it, lower bounds for the `width` next nearest (numbers `near`) and one, `rest`, for all others."""

    def __init__(self, cluster, upper, near, lower, rest):
        self.cluster, self.upper, self.near, self.lower, self.rest = cluster, upper, near, lower, rest

    @staticmethod
    def scan(x: np.ndarray, centroids: np.ndarray, width: int) -> Bounds:
        """From all distances; of equally near centroids the smaller number comes first."""
        d2 = squared(x, centroids)
        order = np.argsort(d2, axis=1, kind="stable")
        sorted_d2 = np.take_along_axis(d2, order, axis=1)
        k = len(centroids)
        rest = _below(sorted_d2[:, width + 1]) if width + 1 < k else np.full(len(x), np.inf, np.float32)
        return Bounds(order[:, 0].astype(np.int32), _above(sorted_d2[:, 0]), order[:, 1 : width + 1].astype(np.int32), _below(sorted_d2[:, 1 : width + 1]), rest)

    def moved(self, shifts: np.ndarray) -> None:
        """Loosen all bounds by how far centroids have moved."""
        self.upper = (self.upper + shifts[self.cluster]) * (1 + SLACK)
        down = lambda v: np.nextafter((v * np.where(v > 0, 1 - SLACK, 1 + SLACK)).astype(np.float32), np.float32(-np.inf))
        self.lower = down(self.lower - shifts[self.near])
        self.rest = down(self.rest.astype(np.float64) - shifts.max(initial=0))

    def narrowed(self, width: int) -> None:
        """Keep the `width` lowest of the lower bounds; the remainder's bound takes in the others."""
        order = np.argsort(self.lower, axis=1, kind="stable")
        self.near, self.lower = np.take_along_axis(self.near, order, axis=1), np.take_along_axis(self.lower, order, axis=1)
        if width < self.near.shape[1]:
            self.rest = np.minimum(self.rest, self.lower[:, width])
            self.near, self.lower = self.near[:, :width], self.lower[:, :width]

    def assign(self, x: np.ndarray, centroids: np.ndarray) -> int:
        """Bring all rows to their nearest centroid; returns how many of the bounds, nearest first, some row could not do without.

        1. An upper bound below all lower ones certifies the row as it is. 2. Else the distance to its own centroid is
        computed, and the test repeated. 3. Where only stored centroids may be as near, their distances are computed and
        the nearest taken. 4. Where the remainder's bound doesn't exclude the others, the row is scanned anew.
        """
        width = self.near.shape[1]
        least = np.minimum(self.lower.min(axis=1, initial=np.inf), self.rest)
        open_ = np.flatnonzero(self.upper >= least)
        if not len(open_):
            return 0
        self.upper[open_] = _above(paired(x[open_], centroids[self.cluster[open_]]))
        open_ = open_[self.upper[open_] >= least[open_]]
        again = self.upper[open_] >= self.rest[open_]
        scanned, known = open_[again], open_[~again]
        used = 0
        if len(known):
            used = int((self.lower[known] <= self.upper[known, None]).sum(axis=1).max())
            numbers = np.concatenate([self.cluster[known, None], self.near[known]], axis=1)
            d2 = paired(x[known], centroids[numbers])
            best = d2.min(axis=1)
            chosen = np.where(d2 == best[:, None], numbers, len(centroids)).min(axis=1)
            others = numbers != chosen[:, None]
            self.cluster[known], self.upper[known] = chosen, _above(best)
            self.near[known], self.lower[known] = numbers[others].reshape(-1, width), _below(d2[others].reshape(-1, width))
        if len(scanned):
            new = Bounds.scan(x[scanned], centroids, width)
            self.cluster[scanned], self.upper[scanned], self.near[scanned], self.lower[scanned], self.rest[scanned] = new.cluster, new.upper, new.near, new.lower, new.rest
            used = width
        return used


def _round(centroids: np.ndarray, shifts: np.ndarray | None, width: int):
    """Rows with their state before, or (id, x) alone in the first round, to rows with their state after; a task ends with a row for each cluster: its vectors, their sums and distances."""
    k, d = centroids.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, inertia, sums, used = np.zeros(k, np.int64), [0] * k, np.zeros((k, d), np.int64), 0
        names = ["id", "x", "cluster", "upper", "distance", "near", "lower", "rest", "used", "n", "inertia", "sums"]
        lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
        kind = None
        for b in batches:
            kind = b.column(0).type
            for at, x in matrices(b, 1, d):
                if shifts is None:
                    s, need = Bounds.scan(x, centroids, width), 0
                else:
                    piece = b.slice(at, len(x))
                    width_of = len(piece.column(piece.schema.get_field_index("near")).flatten()) // len(x)
                    of = lambda c: piece.column(piece.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                    table = lambda c: piece.column(piece.schema.get_field_index(c)).flatten().to_numpy(zero_copy_only=False).reshape(len(x), width_of)
                    s = Bounds(of("cluster").copy(), of("upper").copy(), table("near").copy(), table("lower").copy(), of("rest").copy())
                    s.moved(shifts)
                    s.narrowed(width)
                    need = s.assign(x, centroids)
                used = max(used, need)
                distance = paired(x, centroids[s.cluster])
                n += np.bincount(s.cluster, minlength=k)
                np.add.at(sums, s.cluster, x)
                for c in np.unique(s.cluster).tolist():
                    inertia[c] += int(distance[s.cluster == c].sum())
                null = lambda t: pa.nulls(len(x), t)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(x)), lists(x), pa.array(s.cluster.astype(np.int32)), pa.array(s.upper), pa.array(distance), lists(s.near.astype(np.int32)), lists(s.lower), pa.array(s.rest), null(pa.int32()), null(pa.int64()), null(pa.int64()), null(pa.list_(pa.int64()))], names)
        if kind is not None:
            null = lambda t: pa.nulls(k, t)
            yield pa.RecordBatch.from_arrays([null(kind), null(pa.list_(pa.int64())), pa.array(np.arange(k, dtype=np.int32)), null(pa.float64()), null(pa.int64()), null(pa.list_(pa.int32())), null(pa.list_(pa.float32())), null(pa.float32()), pa.array(np.full(k, used, np.int32)), pa.array(n), pa.array(inertia, pa.int64()), lists(sums)], names)

    return run


def _gathered(state: DataFrame, k: int, d: int) -> tuple[np.ndarray, list[list[int]], list[int], int]:
    """Vectors, sums and inertia of each cluster over all tasks, and the most bounds that were needed: k rows of exact sums."""
    rows = state.where("n is not null").select("cluster", "n", "inertia", "used", "sums")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    each = rows.groupBy("cluster").agg(F.sum("n").alias("n"), whole("inertia").alias("inertia"), F.max("used").alias("used"), *[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)])
    n, sums, inertia, used = np.zeros(k, np.int64), [[0] * d for _ in range(k)], [0] * k, 0
    for r in each.collect():
        n[r["cluster"]], inertia[r["cluster"]], used = r["n"], int(r["inertia"]), max(used, r["used"])
        sums[r["cluster"]] = [int(r[f"s{i}"]) for i in range(d)]
    return n, sums, inertia, used


def seeds(kept: DataFrame, k: int) -> np.ndarray:
    """The k vectors of kept (id, x) whose sha256 of `2:<id>` is smallest, in that order; of equal ids the smaller vector first, null ids last."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)
    rows = kept.select("x", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def integers(vector: Column, scale: int) -> Column:
    """Entries c, as doubles, as floor(scale * c)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, d: int = 64, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, cluster int, distance (squared), cluster_inertia, inertia, centroid_sha256 of the vectors with d entries, none null or non-finite.

    Every distance is one of integers. Each round reads the last one's table and writes the next: the vector, its centroid
    and its bounds, and for each task a row of sums for each cluster, so a vector is read and written once a round and only
    k rows of sums are shuffled for each task. The centroids, k times d numbers, go to every task. There are k / 4 lower
    bounds at first; later rounds keep as many as some vector needed, k / 8 at least.
    Fewer than k vectors: as many centroids. None: no rows. Ties: see `seeds` and the smaller centroid's number. An empty
    cluster keeps its centroid. Null keys stay null, repeated rows are vectors each. A value or a squared distance that no long holds is an error.
    Other columns are ignored, whatever their names.
    """
    spark = rows.sparkSession
    common.ship(spark)
    kind = rows.schema[key].dataType.simpleString()
    kept = rows.where(finite(F.col(vector)) & (F.size(vector) == d)).select(F.col(key).alias("id"), integers(F.col(vector), scale).alias("x"))
    with common.scratch(spark) as keep:
        now = seeds(kept, k)
        if not len(now):
            return spark.createDataFrame([], f"{key} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        k = len(now)
        schema = STATE.format(kind=kind)
        width = max(1, k // 4) if k > 1 else 0
        state = common.materialize(kept.mapInArrow(_round(now, None, width), schema), "clusters")
        for _ in range(rounds):
            n, sums, _, used = _gathered(state, k, d)
            new = np.array([[s // int(m) for s in row] if m else old.tolist() for row, m, old in zip(sums, n, now, strict=True)], np.int64)
            shifts = _above(paired(now, new))
            width = min(width, max(1, k // 8, used))
            last, now = state, new
            state = common.materialize(last.where("n is null").mapInArrow(_round(now, shifts, width), schema), "clusters")
            common.drop(last)
        _, _, inertia, _ = _gathered(state, k, d)
        keep.append(state)
    if sum(inertia) >= 1 << 63:
        raise OverflowError("the inertia doesn't fit in a long")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    of = spark.createDataFrame([(i, inertia[i], sum(inertia), digests[i]) for i in range(k)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.where("n is null").select(F.col("id").alias(key), "cluster", "distance").join(F.broadcast(of), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
