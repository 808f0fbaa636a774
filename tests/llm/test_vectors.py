"""Whitening and clustering of embeddings against plain numpy and Python."""

import hashlib
import math

import numpy as np
import pytest

from loomtext.llm import centroids, common, queries, whitening

DATA = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, id string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], 0, "x", 1) for i, v in rows], SCHEMA)


def usable(v, d=None):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (d is None or len(v) == d)


def plain_whitening(rows, most=16):
    rows = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if usable(v)]
    fit = np.array(sorted({tuple(x) for _, x in rows}), object)
    n, s = len(fit), fit.sum(axis=0)
    c = (fit * n - s).astype(float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    out = {}
    for i, x in rows:
        own = np.array(x, object) * n - s
        out.setdefault(i, []).append((int((own**2).sum()), (own.astype(float) / n) @ u / np.sqrt(e)))
    return n, e / ((c * c).sum() / n), out


def check_whitening(got, rows, components):
    n, explained, want = plain_whitening(rows)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert {k for k, _ in by} == set(want) and {c for _, c in by} == set(range(1, components + 1))
    for (i, c), mine in by.items():
        assert len(mine) == len(want[i])
        for r, (deviation, white) in zip(sorted(mine, key=lambda r: r["deviation"]), sorted(want[i], key=lambda t: t[0]), strict=True):
            assert r["n"] == n and r["deviation"] == deviation and r["identity_error"] <= 1e-9
            assert abs(r["explained"] - explained[c - 1]) <= 1e-9 * explained[c - 1]
            assert abs(abs(r["whitened"]) - abs(white[c - 1])) < 1e-6
    for c in range(1, components + 1):  # one sign for all rows
        signs = {np.sign(r["whitened"] * w[c - 1]) for i, w in ((i, x[0][1]) for i, x in want.items() if len(x) == 1) for r in by[i, c] if abs(r["whitened"]) > 1e-3}
        assert len(signs) == 1


def test_whole_table(spark):
    table = common.table(spark, DATA, "embeddings")
    check_whitening(queries.op11_embedding_whitening(spark, DATA).collect(), [(r[0], r[1]) for r in table.collect()], 16)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows = [*good, (3, good[3][1]), (200, good[4][1]), (None, good[5][1]), (61, None), (62, [1.0, None, 0, 0, 0]), (63, [1.0, math.nan, 0, 0, 0]), (64, [math.inf, 0, 0, 0, 0]), (65, []), (66, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    check_whitening([r for r in got if r["vec_id"] is not None], [r for r in rows if r[0] is not None and r[1] is not None and len(r[1]) == 5], 5)
    assert sorted(r["component"] for r in got if r["vec_id"] is None) == [1, 2, 3, 4, 5]


def test_no_variance(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()
    assert {r["component"] for r in line} == {1} and all(abs(r["explained"] - 1) < 1e-9 for r in line)


@pytest.mark.parametrize("values", [[9, 8, 7, 6, 5, 4, 3, 2], [5] * 8 + [4] * 12 + [1] * 20, [3, 3, 3] + [0] * 30, list(range(200, 0, -1)), [1e9, 1, 1, 1e-3] + [1e-9] * 40])
def test_block_lanczos(values):
    rng = np.random.default_rng(2)
    values = np.array(values, float)
    d = len(values)
    u = np.linalg.qr(rng.normal(size=(d, d)))[0]
    matrix = (u * values) @ u.T
    passes = []

    def multiply(q):
        passes.append(q.shape[1])
        return matrix @ q

    got, vectors = whitening.block_lanczos(multiply, lambda: values.sum(), d, 6, 4, 1e-13)
    assert np.allclose(got, np.sort(values)[::-1][:6], rtol=1e-10, atol=1e-12 * values.max())
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-12) and np.abs(matrix @ vectors - vectors * got).max() < 1e-9 * values.max()
    assert sum(passes) <= d


def plain_clusters(rows, k, rounds, d, scale):
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows if usable(v, d)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [x for _, x in order[:k]]
    x = np.array([v for _, v in kept], np.int64)
    for t in range(rounds + 1):
        d2 = np.stack([((x - np.array(c)) ** 2).sum(axis=1) for c in cs], axis=1)
        at = d2.argmin(axis=1)
        if t < rounds:
            cs = [[int(s) // int((at == c).sum()) for s in x[at == c].sum(axis=0)] if (at == c).any() else cs[c] for c in range(len(cs))]
    near = d2[np.arange(len(x)), at]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted((i if i is not None else -1, int(a), int(e), int(near[at == a].sum()), int(near.sum()), sha[a]) for (i, _), a, e in zip(kept, at, near, strict=True))


def tuples(df):
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in df.collect())


def test_clusters_whole_table(spark):
    rows = [(r[0], r[1]) for r in common.table(spark, DATA, "embeddings").collect()]
    assert tuples(queries.op12_centroid_clustering(spark, DATA)) == plain_clusters(rows, 40, 5, 64, 256)


@pytest.mark.parametrize("k,spread", [(1, 3.0), (2, 3.0), (7, 0.05), (30, 3.0), (500, 1.0)])
def test_clusters(spark, k, spread):
    rng = np.random.default_rng(k)
    rows = [(i, (rng.integers(0, 6, 3) + rng.normal(size=3) * spread).round(1).tolist()) for i in range(300)]
    rows += [(400, rows[0][1]), (0, rows[0][1]), (7, [9.0, 9.0, 9.0]), (None, [0.5, 0.5, 0.5]), (401, None), (402, [1.0, None, 2.0]), (403, [math.nan, 0, 0]), (404, [1.0]), (405, [math.inf, 0, 0])]
    assert tuples(centroids.cluster(frame(spark, rows), k=k, rounds=4, d=3, scale=16)) == plain_clusters(rows, k, 4, 3, 16)


def test_clusters_edges(spark):
    assert centroids.cluster(frame(spark, []), d=3).collect() == []
    big = [(i, [float(2**20 * i), 0.0, 1.0]) for i in range(1, 9)]
    assert tuples(centroids.cluster(frame(spark, big), k=3, rounds=3, d=3, scale=16)) == plain_clusters(big, 3, 3, 3, 16)
    with pytest.raises(OverflowError):
        centroids.squared(np.array([[1 << 40, 0]]), np.array([[-(1 << 40), 0]]))


def test_bounds_are_certain():
    """Drake's rows after many moves equal full scans, with few distances computed anew."""
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, (2000, 6)) * 3 + rng.integers(0, 4, (2000, 6))
    now = x[rng.choice(len(x), 24, replace=False)]
    s = centroids.Bounds.scan(x, now, 6)
    for _ in range(12):
        new = np.array([x[s.cluster == c].sum(axis=0) // max(1, (s.cluster == c).sum()) if (s.cluster == c).any() else now[c] for c in range(24)])
        s.moved(centroids._above(centroids.paired(now, new)))
        s.narrowed(max(3, s.near.shape[1] - 1))
        s.assign(x, new)
        now = new
        d2 = centroids.squared(x, now)
        assert (s.cluster == d2.argmin(axis=1)).all() and (s.upper * s.upper >= d2[np.arange(len(x)), s.cluster]).all()
        assert (s.lower <= np.sqrt(np.take_along_axis(d2, s.near, axis=1))).all()
        out = np.ones_like(d2, bool)
        np.put_along_axis(out, s.near, False, axis=1)
        out[np.arange(len(x)), s.cluster] = False
        assert (s.rest <= np.sqrt(np.where(out, d2, 1 << 40)).min(axis=1)).all()
