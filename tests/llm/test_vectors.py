"""Whitening and clustering of vectors against plain recomputation."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import checker
from spanloom.llm import catalog, centroids, common, oracle, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture
def make_vectors(spark):
    common.prepare(spark)

    def make(*rows):
        return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(3)

    return make


def random_vectors(n, width, rank=None, seed=1):
    rng = np.random.default_rng(seed)
    rank = rank or width
    return (rng.normal(size=(n, rank)) @ rng.normal(size=(rank, width))).astype(np.float32).tolist()


BROKEN = [
    (900, None), (901, []), (902, [None] * 6), (903, [1.0, 2.0, None, 1.0, 1.0, 1.0]),
    (904, [1.0, math.nan, 1.0, 1.0, 1.0, 1.0]), (905, [math.inf] * 6), (906, [1.0, 2.0]),
]


def check_whitened(rows, vectors, clashing=None):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    centred = (x - np.array([s / n for s in sums])).astype(float)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    kept = int((values > 1e-9 * values[0]).sum()) if n else 0
    model = whitening.fit(rows)
    assert len(model.eigenvalues) == min(32, kept)
    assert np.allclose(model.eigenvalues, values[:min(32, kept)], rtol=1e-9)
    error = whitening.identity_error(rows, model)
    assert error < 1e-9
    out = whitening.transform(rows, model).collect()
    assert len(out) == n
    places = {}
    for i, (name, v) in enumerate(vectors):
        places.setdefault((name, tuple(v)), i)
    expected = centred @ directions[:, :min(32, kept)] / np.sqrt(values[:min(32, kept)])
    signs = None
    for r in out:
        candidates = [i for (name, _), i in places.items() if name == r.id]
        best = min(candidates, key=lambda i: np.abs(np.abs(expected[i]) - np.abs(r.whitened)).max())
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[best], sums, strict=True))
        signs = np.sign(expected[best] * r.whitened) if signs is None else signs
        assert np.allclose(expected[best] * signs, r.whitened, atol=1e-6)
    return model


def test_whitening_is_the_eigenbasis(make_vectors):
    vectors = list(enumerate(random_vectors(200, 6))) + [(None, [1.0] * 6), (3, [0.5] * 6), (3, [0.5] * 6)]
    rows = make_vectors(*vectors, *BROKEN).withColumns({"id": F.lit("x"), "_id": F.lit("y"), "n": F.lit(1)})
    check_whitened(rows, vectors)


def test_whitening_of_many_and_of_dependent_dimensions(make_vectors):
    wide = list(enumerate(random_vectors(150, 41)))
    assert len(check_whitened(make_vectors(*wide), wide).eigenvalues) == 32
    # two dimensions repeat others, one never varies
    narrow = [(i, [*v, v[0], v[1], 2.0]) for i, v in enumerate(random_vectors(90, 4))]
    assert len(check_whitened(make_vectors(*narrow), narrow).eigenvalues) == 4


def test_whitening_of_little(spark, make_vectors, tmp_path):
    assert whitening.fit(make_vectors(*BROKEN[:3])) is None
    assert whitening.fit(make_vectors((1, [1.0, 2.0])).limit(0)) is None
    same = make_vectors(*[(i, [1.0, -2.0, 3.0]) for i in range(5)])
    model = whitening.fit(same)
    assert len(model.eigenvalues) == 0 and whitening.identity_error(same, model) == 0
    assert {(r.deviation, tuple(r.whitened)) for r in whitening.transform(same, model).collect()} == {(0, ())}
    for name, rows in (("none", same.limit(0)), ("same", same)):
        rows.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        assert catalog.queries()["op11_whitening"](spark, f"{tmp_path}/{name}").count() == 0


def test_large_values_stay_exact():
    model = whitening.Whitening(
        2, 10**9, np.array([5, -3]), np.array([7, 10**9 - 1]), np.eye(2), np.ones(2), 2.0, 64, 0
    )
    x = np.array([[2**40, -(2**40)], [5, -3]])
    exact = [sum((10**9 * (a - m) - r) ** 2 for a, m, r in zip(row, (5, -3), (7, 10**9 - 1), strict=True)) for row in x.tolist()]
    found = model.deviation(x).to_pylist()
    assert found == [None if v >= 10**38 else v for v in exact] and found[1] is not None


def test_decomposition():
    rng = np.random.default_rng(3)
    for size, rank in ((1, 1), (2, 2), (7, 7), (20, 5), (33, 33)):
        a = rng.normal(size=(size, rank)) * 10.0 ** rng.uniform(-2, 2, size=rank)
        factor, order = whitening.pivoted_cholesky(a @ a.T)
        assert factor.shape[1] == rank
        assert np.allclose(factor @ factor.T, (a @ a.T)[order][:, order])
        values, directions = whitening.decompose(a @ a.T)
        assert np.allclose(values, np.sort(np.linalg.svd(a, compute_uv=False) ** 2)[::-1][:rank])
        assert np.allclose(directions.T @ directions, np.eye(rank), atol=1e-9)
    assert whitening.pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)


# ---------------------------------------------------------------- centroids


def brute_clusters(vectors, k=8, rounds=10):
    kept = [
        (i, [math.floor(1024 * c) for c in v]) for i, v in vectors
        if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)
    ]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, members in groups.items():
            points[c] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    rows = [(i, *nearest(v)[::-1]) for i, v in kept]
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    whole = sum(r[2] for r in rows)
    per = {c: sum(r[2] for r in rows if r[1] == c) for c in range(len(points))}
    return sorted(((i, c, d, per[c], whole, digests[c]) for i, c, d in rows), key=str)


def test_clusters_are_brute_force(spark, make_vectors, tmp_path):
    rng = random.Random(5)
    centres = random_vectors(5, 64, seed=2)
    vectors = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 5]]) for i in range(150)]
    vectors = [(i, np.float32(v).tolist()) for i, v in vectors]
    vectors += [(None, vectors[0][1]), (7, vectors[8][1]), (8, vectors[8][1]), (200, [0.0] * 64), (201, [0.0] * 64)]
    odd = [*BROKEN, (300, [1.0] * 63), (301, [1.0] * 63 + [math.nan]), (302, [None] + [0.0] * 63)]
    rows = make_vectors(*vectors, *odd).withColumns({"id": F.lit("x"), "x": F.lit(1), "cluster": F.lit(2)})
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = catalog.queries()["op13_centroids"](spark, str(tmp_path))
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == brute_clusters(vectors)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select vec_id, embedding from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert checker.compare(found, con, oracle.oracle_sql()["op13_centroids"]) is None


def test_few_and_equal_vectors(spark, make_vectors, tmp_path):
    for name, vectors in (
        ("none", []), ("three", [(i, [float(i)] * 64) for i in range(3)]), ("same", [(i, [0.5] * 64) for i in range(20)]),
    ):
        make_vectors(*vectors, (99, None)).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        found = catalog.queries()["op13_centroids"](spark, f"{tmp_path}/{name}")
        names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == brute_clusters(vectors)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(9)
    centres = rng.integers(-40_000, 40_000, (8, 64))
    x = centres[rng.integers(0, 8, 500)] + rng.integers(-300, 300, (500, 64))
    pivots = centroids.Pivots(centres[:4])
    near, points = pivots.distances(x), centres + rng.integers(-50, 50, (8, 64))
    exact = np.stack([centroids.squared(x, p) for p in points], axis=1)
    assert (centroids.lower_bounds(near, points, pivots) <= exact).all()
    label, best, computed = centroids.assign(x, near, points, pivots)
    assert (label == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert computed < exact.size / 2
