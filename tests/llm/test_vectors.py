"""Clusters and whitening of vectors."""

import hashlib
import math

import numpy as np
import pytest

from gridloom.llm import exponion, oracles, queries, vectors, whitening

from ..oracle import compare, connect


def usable(spark, path):
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    return [(r.vec_id, r.embedding) for r in rows if r.embedding and len(r.embedding) == 64 and all(v is not None and math.isfinite(v) for v in r.embedding)]


def lloyd(x, ids, k, rounds, seed="3"):
    """Clusters by looking at all centroids, in plain whole numbers."""
    order = sorted(range(len(x)), key=lambda i: (hashlib.sha256(f"{seed}:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), x[i].astype("<i4").tobytes()))
    now = [x[i].copy() for i in order[:k]]
    for turn in range(rounds + 1):
        squares = np.array([((x - c) ** 2).sum(axis=1) for c in now]).T
        of = squares.argmin(axis=1)
        if turn < rounds:
            now = [x[of == c].sum(axis=0) // (of == c).sum() if (of == c).any() else now[c] for c in range(len(now))]
    return of, squares.min(axis=1), now


def test_clusters_against_all_centroids(spark, folder, answer):
    known = usable(spark, folder[0])
    x = np.floor(1024 * np.array([v for _, v in known], dtype=np.float64)).astype(np.int64)
    of, squares, centroids = lloyd(x, [i for i, _ in known], 8, 10)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    within = [int(squares[of == c].sum()) for c in range(8)]
    want = [(i, int(c), int(d), within[c], int(squares.sum()), digest[c]) for (i, _), c, d in zip(known, of, squares, strict=True)]
    got = [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in answer("op11_centroid_clusters")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_clusters_equal_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(queries.op11_centroid_clusters(spark, sf), connect(sf), oracles.CLUSTERS) > 0


@pytest.mark.parametrize(("k", "spread"), [(1, 9), (2, 3), (40, 2), (64, 400)])
def test_balls_hold_nearest_and_ties(k, spread):
    """Bounds and rings against all centroids, over rounds of moving centroids; small numbers make many ties."""
    rng = np.random.default_rng(k)
    x = rng.integers(-spread, spread + 1, (3000, 4))
    then = exponion.Centroids(x[:k])
    cluster, upper, lower = exponion.scan(x, then)
    looked = 0
    for _ in range(6):
        at = np.array([x[cluster == c].sum(axis=0) // max(1, (cluster == c).sum()) if (cluster == c).any() else then.at[c] for c in range(k)])
        now = exponion.Centroids(at)
        squares = now.squared(x, np.arange(k))
        assert (squares == ((x[:, None] - at[None]) ** 2).sum(axis=2)).all()
        cluster, upper, lower, done = exponion.search(x, cluster, upper, lower, then, now)
        assert (cluster == squares.argmin(axis=1)).all()
        root = np.sqrt(squares)
        own, others = root[np.arange(len(x)), cluster], root.copy()
        others[np.arange(len(x)), cluster] = np.inf
        assert (upper >= own * (1 - 1e-12)).all() and (lower <= others.min(axis=1) * (1 + 1e-12)).all()
        looked, then = looked + done, now
    assert k < 64 or looked < 0.5 * 6 * k * len(x)


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(2)
    x = rng.integers(-(1 << 25), 1 << 25, (200, 64))
    now = exponion.Centroids(x[:5])
    assert now.squared(x, np.arange(5)).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in x[:5]] for p in x]


def test_few_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 0.0])]
    frame = spark.createDataFrame(rows, "name int, v array<double>")
    for rounds in (0, 1, 6):
        found, centroids = exponion.clustered(frame, 8, rounds, 2, 10, id="name", vector="v")
        got = {r.name: (r.cluster, r.distance, r.inertia) for r in found.collect()}
        assert len(centroids) == 3 and got[1] == got[2] and got[1][1:] == (0, 0) and got[3][0] != got[1][0]
    with pytest.raises(Exception, match="must lie below"):
        exponion.clustered(spark.createDataFrame([(1, [1e9, 0.0])], "name int, v array<double>"), 2, 1, 2, 10, id="name", vector="v")


def test_no_vectors(spark, empty):
    for name in ("op11_centroid_clusters", "op12_whitening"):
        assert queries.queries()[name](spark, empty).count() == 0


def test_residues_give_exact_sums():
    rng = np.random.default_rng(4)
    y = rng.integers(-(1 << 40), 1 << 40, (500, 6))
    moduli = whitening.primes(500 * (1 << 40) ** 2)
    assert all(all(p % q for q in range(2, math.isqrt(p) + 1)) for p in moduli) and math.prod(moduli) > 1000 * (1 << 80)
    parts = [whitening.residue_scatter(y, p) for p in moduli]
    exact = [[sum(a * b for a, b in zip(y[:, i].tolist(), y[:, j].tolist(), strict=True)) for j in range(6)] for i in range(6)]
    assert [[whitening.remaindered([int(p[i, j]) for p in parts], moduli) for j in range(6)] for i in range(6)] == exact


def test_whitening_against_plain_numbers(spark, folder, answer):
    known = usable(spark, folder[0])
    x = np.floor(64 * np.array([v for _, v in known], dtype=np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    rows = answer("op12_whitening")
    assert len(rows) == 16 * len(known) and {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9
    want = sorted((repr(i), int(d), *np.abs(w)) for (i, _), d, w in zip(known, ((n * x - sums) ** 2).sum(axis=1), ((x - sums / n) @ components[:, :16]) / np.sqrt(values[:16]), strict=True))
    of = {}
    for r in rows:
        of.setdefault((repr(r.vec_id), r.deviation), []).append((r.component, abs(r.whitened)))
    assert {k: len(v) % 16 for k, v in of.items()} == dict.fromkeys(of, 0)
    for name, deviation, *w in want:
        mine = of[name, deviation]
        assert all(min(abs(v - w[c - 1]) for k, v in mine if k == c) < 1e-6 for c in range(1, 17))
    share = {r.component: r.explained for r in rows}
    assert np.allclose([share[c] for c in range(1, 17)], values[:16] / values.sum(), rtol=1e-9)


def test_whitening_of_little(spark):
    make = lambda rows: spark.createDataFrame(rows, "name string, v array<double>")
    assert whitening.whitened(make([("a", [1.0, 2.0]), (None, [1.0, 2.0])]), id="name", vector="v").count() == 0
    assert whitening.whitened(make([("a", None), ("b", [])]), id="name", vector="v").count() == 0
    line = whitening.whitened(make([("a", [0.0, 0.0]), ("b", [1.0, 2.0]), ("b", [1.0, 2.0]), ("c", [1.0])]), id="name", vector="v").collect()
    assert sorted((r.name, r.component, r.n, round(abs(r.whitened), 9), round(r.explained, 9)) for r in line) == [("a", 1, 2, 1.0, 1.0), ("b", 1, 2, 1.0, 1.0), ("b", 1, 2, 1.0, 1.0)]
    assert {r.deviation for r in line} == {64**2 + 128**2}


def test_mean_far_above_the_spread(spark):
    """The third entry varies by 1 around 4e6, and another copies it but for one row: plain doubles would lose it."""
    rows = [(i, [float(i % 2), float(i // 2), 60_000.0 + (i % 3 == 0) / 64]) for i in range(50)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id int, v array<double>"), 3, vector="v").collect()
    assert len(found) == 150 and max(r.identity_error for r in found) < 1e-8


def test_usable_rows_only(spark):
    rows = [(1, [1.5, -0.25]), (2, [None, 1.0]), (3, None), (4, [1.0]), (5, [float("-inf"), 0.0]), (6, [-1.5, 0.0])]
    found = vectors.whole(spark.createDataFrame(rows, "i int, v array<double>"), "v", ["i"], 2, 2, 10).collect()
    assert {r.i: np.frombuffer(r.x, dtype="<i4").tolist() for r in found} == {1: [13, 9], 6: [7, 10]}
