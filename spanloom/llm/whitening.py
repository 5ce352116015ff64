"""Whitening of embeddings: principal components of unit variance, from exact integer sums.

An entry becomes an integer, ``floor(scale * entry) + offset``.  Its sums are exact, so that the mean
is taken away before anything is multiplied: with ``S = n * m + r`` per dimension the centred entry is
``(x - m) - r / n``, rounded once.  Tasks add up the products of centred entries; a row per pair of
dimensions and task is what goes through the shuffle.

The centred scatter is factored by Cholesky with complete pivoting, which stops at the numerical rank.
One-sided Jacobi then turns columns of the triangular factor against each other until all are
orthogonal: squared norms are the eigenvalues, normalised columns the components.  The columns of a round
share none, so they turn side by side.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, stored
from spanloom.llm.vectors import lists, matrix, usable

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Scaled entries are held to this size, so that differences of two stay 64-bit integers.
LARGEST = 1 << 40
#: A pivot this much smaller than the largest is rounding; its dimensions say nothing new.
NEGLIGIBLE = 1e-12
SWEEPS = 60
#: Entries of partial sums a task keeps before it hands them on.
_HELD = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """What was fitted.  ``directions`` has a column per component, by falling eigenvalue."""

    width: int
    n: int
    whole: np.ndarray  # floor of the mean
    rest: np.ndarray  # n times what the floor leaves
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    scale: int
    offset: int

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of ``(n * x - S)^2``, exact; null beyond 38 digits."""
        apart = x - self.whole
        largest = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if largest * largest * self.width < 1 << 63:
            turned = self.n * apart - self.rest
            return pa.array((turned * turned).sum(axis=1)).cast(pa.decimal128(38, 0))
        turned = self.n * apart.astype(object) - self.rest.astype(object)
        sums = [int(v) for v in (turned * turned).sum(axis=1)]
        return pa.array(
            [decimal.Decimal(v) if v < 10**38 else None for v in sums], pa.decimal128(38, 0)
        )


def integers(entries: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    held = np.clip(np.floor(scale * entries), -LARGEST, LARGEST)
    return held.astype(np.int64) + offset


# ---------------------------------------------------------------- the decomposition


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``factor`` and ``order`` with ``a[order][:, order] = factor @ factor.T``; a column per rank."""
    size = len(a)
    order = np.arange(size)
    left = np.diag(a).copy()
    factor = np.zeros((size, size))
    least = NEGLIGIBLE * left.max(initial=0)
    for k in range(size):
        pivot = k + int(np.argmax(left[k:]))
        if left[pivot] <= least:
            return factor[:, :k], order
        for rows in (order, left, factor):
            rows[[k, pivot]] = rows[[pivot, k]]
        factor[k, k] = np.sqrt(left[k])
        below = a[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]
        factor[k + 1:, k] = below / factor[k, k]
        left[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def _meetings(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``size`` numbers (even) once, in rounds of disjoint pairs."""
    circle = np.arange(size)
    for _ in range(size - 1):
        yield circle[:size // 2], circle[size // 2:][::-1]
        circle = np.concatenate([circle[:1], np.roll(circle[1:], 1)])


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor with its columns turned until they are orthogonal, longest first."""
    rank = factor.shape[1]
    rows = np.zeros((rank + rank % 2, len(factor)))
    rows[:rank] = factor.T
    small = np.finfo(float).eps * np.sqrt(len(factor) + 1)
    for _ in range(SWEEPS if rank else 0):
        turned = False
        for p, q in _meetings(len(rows)):
            a, b = rows[p], rows[q]
            aa, bb, ab = ((u * v).sum(axis=1) for u, v in ((a, a), (b, b), (a, b)))
            apart = np.abs(ab) > small * np.sqrt(aa * bb)
            if not apart.any():
                continue
            turned = True
            zeta = (bb - aa) / (2 * np.where(apart, ab, 1))
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            tangent = np.where(apart, tangent, 0.0)
            cosine = (1 / np.hypot(1, tangent))[:, None]
            sine = cosine * tangent[:, None]
            rows[p], rows[q] = cosine * a - sine * b, sine * a + cosine * b
        if not turned:
            break
    else:
        if rank:
            raise ArithmeticError(f"columns are not orthogonal after {SWEEPS} sweeps")
    norms = np.sqrt((rows[:rank] ** 2).sum(axis=1))
    return rows[:rank][np.argsort(-norms, kind="stable")].T


def decompose(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a scatter matrix, falling, and unit eigenvectors as columns."""
    factor, order = pivoted_cholesky(scatter)
    columns = one_sided_jacobi(factor)
    norms = np.sqrt((columns ** 2).sum(axis=0))
    out = np.empty_like(columns)
    out[order] = columns / norms
    return norms ** 2, out


# ---------------------------------------------------------------- sums over all rows


def _vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return df.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )


def _exact_sums(vectors: DataFrame, scale: int, offset: int) -> tuple[int, int, list[int]]:
    """Width, number of vectors and sum per dimension of the most frequent width (ties: the wider)."""

    def rows(held: dict) -> dict:
        out = [(w, i, n, decimal.Decimal(s)) for w, (n, sums) in held.items() for i, s in enumerate(sums)]
        return dict(zip(("width", "i", "n", "total"), map(list, zip(*out, strict=True)), strict=True))

    def run(batches: Batches) -> Iterator[dict]:
        held: dict[int, list] = {}
        for batch in batches:
            lengths, begin, values = usable(batch.column("vector"))
            for width in set(lengths[lengths > 0].tolist()):
                x = integers(matrix(begin, values, np.flatnonzero(lengths == width), width), scale, offset)
                n, sums = held.get(width, (0, [0] * width))
                held[width] = n + len(x), [s + int(v) for s, v in zip(sums, x.sum(axis=0), strict=True)]
            if sum(held) > _HELD:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    parts = map_rows(vectors.select("vector"), run, "width int, i int, n long, total decimal(38,0)")
    sums = stored(parts.groupBy("width", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "sums")
    most = sums.filter("i = 0").orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return 0, 0, []
    # as many rows as a vector has entries
    found = sums.filter(F.col("width") == most["width"]).orderBy("i").collect()
    return most["width"], most["n"], [int(r["total"]) for r in found]


def _products(
    vectors: DataFrame, width: int, n: int, centred: Callable[[np.ndarray], np.ndarray], size: int,
    scale: int, offset: int,
) -> np.ndarray:
    """Covariance of centred rows over all vectors of the width.

    What centring left of the mean, rounding alone, is taken away from the sums of products.  The driver
    gets a number per pair of dimensions, whatever the number of rows.
    """
    upper = np.triu_indices(size)

    def run(batches: Batches) -> Iterator[dict]:
        products, sums = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            lengths, begin, values = usable(batch.column("vector"))
            rows = np.flatnonzero(lengths == width)
            c = centred(integers(matrix(begin, values, rows, width), scale, offset))
            products += c.T @ c
            sums += c.sum(axis=0)
        yield {
            "i": np.append(upper[0], np.arange(size)), "j": np.append(upper[1], np.full(size, -1)),
            "value": np.append(products[upper], sums),
        }

    parts = map_rows(vectors.select("vector"), run, "i int, j int, value double")
    found = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    i, j, value = (found[c].to_numpy() for c in ("i", "j", "value"))
    mean = np.zeros(size)
    mean[i[j < 0]] = value[j < 0] / n
    out = np.zeros((size, size))
    out[i[j >= 0], j[j >= 0]] = value[j >= 0] / n
    out = np.triu(out) + np.triu(out, 1).T
    return out - np.outer(mean, mean)


def fit(
    df: DataFrame, vector_column: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, offset: int = OFFSET,
) -> Whitening | None:
    """Fit on all usable vectors; None when there is none.

    Null vectors and those with null or non-finite entries are left out, and so are vectors of another
    width than the most frequent one (ties: the wider).  Equal vectors count as often as they come.
    Dimensions that never vary, or follow from others, give no component; there may be none at all.
    """
    vectors = _vectors(df.withColumn("_id", F.lit(0)), "_id", vector_column)
    width, n, sums = _exact_sums(vectors, scale, offset)
    if not n:
        return None
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    none = np.zeros((width, 0))
    start = Whitening(width, n, whole, rest, none, np.zeros(0), 0.0, scale, offset)
    covariance = _products(vectors, width, n, start.centred, width, scale, offset)
    values, directions = decompose(covariance * n)
    kept = min(components, len(values))
    return Whitening(
        width, n, whole, rest, directions[:, :kept], values[:kept] / n, float(np.trace(covariance)),
        scale, offset,
    )


def identity_error(df: DataFrame, model: Whitening, vector_column: str = "embedding") -> float:
    """How far the covariance of the whitened vectors, measured over all rows, is from the identity."""
    size = len(model.eigenvalues)
    if not size:
        return 0.0
    vectors = _vectors(df.withColumn("_id", F.lit(0)), "_id", vector_column)
    found = _products(vectors, model.width, model.n, model.whitened, size, model.scale, model.offset)
    return float(np.abs(found - np.eye(size)).max())


def transform(
    df: DataFrame, model: Whitening, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``id``, ``deviation decimal(38,0)`` and ``whitened array<double>`` per usable vector; no shuffle."""

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            lengths, begin, values = usable(batch.column("vector"))
            rows = np.flatnonzero(lengths == model.width)
            x = integers(matrix(begin, values, rows, model.width), model.scale, model.offset)
            yield {
                "id": batch.column("id").take(pa.array(rows)), "deviation": model.deviation(x),
                "whitened": lists(model.whitened(x)),
            }

    vectors = _vectors(df, id_column, vector_column)
    return map_rows(vectors, run, "id long, deviation decimal(38,0), whitened array<double>")


def by_component(whitened: DataFrame, model: Whitening, error: float) -> DataFrame:
    """A row per vector and component, numbered from 1."""
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    spread = whitened.select("id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return spread.select(
        "id", (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
