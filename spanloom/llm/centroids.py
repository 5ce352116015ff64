"""Clustering around centroids: assignments pruned by Ptolemy's inequality over fixed pivot pairs.

Vectors are integers, so distances, sums and means are exact.  Each vector's distances to some fixed
pivots are computed once and stored beside it.  For a pivot pair ``(p, s)``, a vector ``x`` and a centroid
``c``, Ptolemy's inequality gives

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s),

so every round compares stored numbers with the few distances between centroids and pivots.  The bound is
lowered by more than its rounding, and a centroid is left out only where it lies beyond the best exact
distance so far; all others are compared exactly, which decides ties as well.

A round is one scan without a shuffle of vectors: tasks hand on sums per cluster and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, stored
from spanloom.llm.vectors import lists, matrix, square, usable

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SALT = "3:"
#: Scaled components are held to this size; squared distances then fit 64 bits.
LARGEST = 1 << 27
#: More than what the few roundings of a bound can add up to.
MARGIN = 64 * np.finfo(float).eps

_SCALED = "id long, x array<int>"


def scaled(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", width: int = WIDTH,
    scale: int = SCALE,
) -> DataFrame:
    """``id`` and ``x``, the floor of each component times ``scale``.

    Vectors of another width, null ones and those with null or non-finite components are left out.
    """

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            lengths, begin, values = usable(batch.column("vector"))
            rows = np.flatnonzero(lengths == width)
            x = np.floor(scale * matrix(begin, values, rows, width))
            yield {
                "id": batch.column("id").take(pa.array(rows)),
                "x": lists(np.clip(x, -LARGEST, LARGEST).astype(np.int32)),
            }

    vectors = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    return map_rows(vectors, run, _SCALED)


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, salt: str = SALT) -> np.ndarray:
    """The vectors whose IDs have the smallest digests; null IDs come last, equal IDs by components."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    found = vectors.orderBy(digest.asc_nulls_last(), "x").limit(clusters).collect()
    return np.array([r["x"] for r in found], np.int64)


def squared(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    apart = x - point
    return np.einsum("ij,ij->i", apart, apart)


@dataclass(frozen=True)
class Pivots:
    """Fixed points and the pairs of them that lie apart."""

    points: np.ndarray

    @property
    def pairs(self) -> list[tuple[int, int]]:
        between = self.distances(self.points)
        return [(p, s) for p, s in combinations(range(len(self.points)), 2) if between[p, s] > 0]

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([squared(x, p) for p in self.points], axis=1).astype(float))


def lower_bounds(near: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Squared distances that no vector falls below, per vector and centroid."""
    to_pivots, between = pivots.distances(centroids), pivots.distances(pivots.points)
    best = np.zeros((len(near), len(centroids)))
    for p, s in pivots.pairs:
        one = near[:, p, None] * to_pivots[:, s]
        other = near[:, s, None] * to_pivots[:, p]
        np.maximum(best, (np.abs(one - other) - MARGIN * (one + other)) / between[p, s], out=best)
    return best * best * (1 - MARGIN)


def assign(
    x: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: Pivots
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number), squared distance, and how many were computed."""
    bounds = lower_bounds(near, centroids, pivots)
    label = np.argmin(bounds, axis=1)
    apart = x - centroids[label]
    best = np.einsum("ij,ij->i", apart, apart)
    first, computed = label.copy(), len(x)
    for c in range(len(centroids)):
        # compared upwards: a bound that is only just beyond does not count
        open_rows = np.flatnonzero((bounds[:, c] <= best * (1 + MARGIN)) & (first != c))
        if not len(open_rows):
            continue
        computed += len(open_rows)
        found = squared(x[open_rows], centroids[c])
        closer = (found < best[open_rows]) | ((found == best[open_rows]) & (c < label[open_rows]))
        rows = open_rows[closer]
        label[rows], best[rows] = c, found[closer]
    return label, best, computed


def with_pivots(vectors: DataFrame, pivots: Pivots, width: int = WIDTH) -> DataFrame:
    """The vectors with their distances to the pivots, stored."""

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            x = square(batch.column("x"), width).astype(np.int64)
            yield {"id": batch.column("id"), "x": batch.column("x"), "near": lists(pivots.distances(x))}

    return stored(map_rows(vectors, run, f"{_SCALED}, near array<double>"), "pivot-distances")


def _moved(cached: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Centroids after one round: floors of the exact means, empty ones as they were."""
    k, width = centroids.shape

    def run(batches: Batches) -> Iterator[dict]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            x = square(batch.column("x"), width).astype(np.int64)
            near = square(batch.column("near"), len(pivots.points))
            label, _, _ = assign(x, near, centroids, pivots)
            counts += np.bincount(label, minlength=k)
            for c in range(k):
                totals[c] += x[label == c].sum(axis=0)
        yield {
            "cluster": np.repeat(np.arange(k), width), "i": np.tile(np.arange(width), k),
            "n": np.repeat(counts, width), "total": totals.ravel(),
        }

    parts = map_rows(cached.select("x", "near"), run, "cluster int, i int, n long, total long")
    wide = F.sum(F.col("total").cast("decimal(38,0)"))
    # a row per cluster and dimension comes back
    moved = centroids.copy()
    for r in parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), wide.alias("total")).collect():
        if r["n"]:
            moved[r["cluster"], r["i"]] = int(r["total"]) // r["n"]
    return moved


def _assigned(cached: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    width = centroids.shape[1]

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            x = square(batch.column("x"), width).astype(np.int64)
            near = square(batch.column("near"), len(pivots.points))
            label, best, computed = assign(x, near, centroids, pivots)
            yield {"id": batch.column("id"), "cluster": label, "distance": best}

    return stored(map_rows(cached, run, "id long, cluster int, distance long"), "assigned")


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT, width: int = WIDTH,
) -> tuple[DataFrame, np.ndarray]:
    """``id``, ``cluster`` and squared ``distance`` per row of ``scaled`` vectors, and the centroids.

    The pivots are the first centroids.  Rows of equal or null IDs are vectors of their own; with fewer
    vectors than clusters there are as many clusters as vectors, without any an empty result.
    """
    vectors = stored(vectors, "scaled")
    centroids = first_centroids(vectors, clusters, salt)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "id long, cluster int, distance long"), centroids
    pivots = Pivots(centroids)
    cached = with_pivots(vectors, pivots, width)
    for _ in range(rounds):
        centroids = _moved(cached, centroids, pivots)
    return _assigned(cached, centroids, pivots), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds each cluster's and the whole inertia (null beyond 64 bits) and the centroid's digest."""
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(wide.alias("s")).collect()}
    held = [v if v < 1 << 63 else None for v in (*sums.values(), sum(sums.values()))]
    digests = [
        hashlib.sha256(",".join(str(int(v)) for v in centroids[c]).encode()).hexdigest() for c in sums
    ]
    # a row per cluster
    facts = assigned.sparkSession.createDataFrame(
        list(zip(sums, held, [held[-1]] * len(sums), digests, strict=False)),
        "_c int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("_c")).drop("_c")
