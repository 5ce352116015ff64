"""Quality scores from preference pairs (Bradley-Terry), cut at a score quantile.

Each training pair holds a document marked good and one marked bad.  The model is one weight per
feature; the probability that the good one wins is the logistic function of the difference of their
weighted features.  Features describe the shape of a text only: its characters, words and lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, strings

#: Labelled rows that are used for fitting, at most; the fit runs on the driver over their features.
SAMPLE_ROWS = 20_000
PAIRS = 60_000
ACCEPT_SCORE = 0.7
_PUNCTUATION = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)
_DIGITS, _UPPER = np.arange(48, 58), np.arange(65, 91)
_SHAPE = 12
FEATURES = _SHAPE + len(_PUNCTUATION)


def features(text: str) -> np.ndarray:
    """Shares and averages of a whole text; an empty one is all zeros."""
    out = np.zeros(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    plain_ends = (ends >= 97) & (ends <= 122) | (ends >= 128)
    stops = np.isin(ends, np.frombuffer(b".,;:?", np.uint8))
    distinct = len(set(words))
    out[:_SHAPE] = (
        np.log1p(len(words)),
        sizes.mean() / 10,
        sizes.std() / 10,
        distinct / len(words),
        len(set(lines)) / len(lines),
        np.log1p(len(words) / len(lines)),
        counts[_DIGITS].sum() / n,
        counts[_UPPER].sum() / n,
        counts[128:].sum() / n,
        plain_ends.mean(),
        (~(plain_ends | stops)).mean(),
        np.log1p(distinct),
    )
    out[_SHAPE:] = np.sqrt(counts[_PUNCTUATION] / n)
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    #: latent score at the chosen quantile
    cut: float
    quantile: float

    def latent(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``ACCEPT_SCORE`` exactly at the cut."""
        shift = np.log(ACCEPT_SCORE / (1 - ACCEPT_SCORE))
        return 1 / (1 + np.exp(-np.clip(self.latent(x) - self.cut + shift, -500, 500)))


def fit_pairs(x: np.ndarray, good: np.ndarray, seed: int = 7, penalty: float = 1e-3) -> Model:
    """Newton steps on the penalised logistic loss of feature differences, then the quantile.

    Without both labels there are no pairs: the weights are zero and everything is accepted.
    """
    x = x.reshape(-1, FEATURES)
    mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = x.std(axis=0) if len(x) else np.ones(FEATURES)
    scale = np.where(scale > 1e-9, scale, 1.0)
    weights = np.zeros(FEATURES)
    ups, downs = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(ups) or not len(downs):
        return Model(mean, scale, weights, 0.0, 0.0)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    pairs = min(PAIRS, len(ups) * len(downs))
    d = z[rng.choice(ups, pairs)] - z[rng.choice(downs, pairs)]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ weights, -500, 500)))
        slope = d.T @ (p - 1) / pairs + penalty * weights
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + penalty * np.eye(FEATURES)
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    latent = z @ weights
    # the quantile of all scores that divides the two labels best, both counting alike
    levels = np.linspace(0, 1, 1001)
    cuts = np.quantile(latent, levels)
    rising, falling = np.sort(latent[ups]), np.sort(latent[downs])
    kept = 1 - np.searchsorted(rising, cuts, "left") / len(ups)
    refused = np.searchsorted(falling, cuts, "left") / len(downs)
    best = np.flatnonzero(kept + refused >= (kept + refused).max() - 1e-12)
    chosen = best[len(best) // 2]
    return Model(mean, scale, weights, float(cuts[chosen]), float(levels[chosen]))


def bucket(id_column: str):
    """crc32 of the ID as text, modulo 4; a null ID counts as empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id",
    text_column: str = "text", label_column: str = "quality", held_out_bucket: int | None = 2,
) -> Model:
    """Learn from labelled documents outside the held-out bucket.

    Of the labelled rows those with the smallest hashed IDs are taken, ``sample_rows`` at most, so
    the table that is broadcast and the features that come to the driver are bounded.  Null labels
    and labels other than 0 and 1 say nothing.
    """
    usable = labels.filter(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    if held_out_bucket is not None:
        usable = usable.filter(bucket(id_column) != held_out_bucket)
    chosen = usable.select(
        F.col(id_column).alias("_id"), F.col(label_column).alias("_label")
    ).orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows)
    texts = docs.select(F.col(id_column).alias("_doc"), F.col(text_column).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select(
        "text", F.col("_label").cast("int").alias("label")
    )

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            yield {
                "label": batch.column("label"),
                "x": [features(t).tobytes() for t in strings(batch.column("text"))],
            }

    taken = map_rows(rows, run, "label int, x binary").limit(2 * sample_rows).toPandas()
    # in a settled order, so that a repeated run draws the same pairs
    taken = taken.sort_values(["x", "label"], kind="stable")
    x = np.frombuffer(b"".join(taken["x"]), np.float64) if len(taken) else np.zeros(0)
    return fit_pairs(x, taken["label"].to_numpy())


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` columns are left out: ``(doc_id, score, predicted)`` per row."""

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            texts = strings(batch.column("text"))
            x = np.array([features(t) for t in texts]).reshape(-1, FEATURES)
            s = model.score(x)
            yield {"doc_id": batch.column("id"), "score": s,
                   "predicted": (s >= ACCEPT_SCORE).astype(np.int32)}

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    return map_rows(rows, run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """Documents that score ``ACCEPT_SCORE`` or more, all columns as they were."""

    def run(batches: Batches) -> Iterator:
        for batch in batches:
            x = np.array([features(t) for t in strings(batch.column(text_column))])
            yield batch.filter(_mask(model.score(x.reshape(-1, FEATURES)) >= ACCEPT_SCORE))

    return docs.mapInArrow(run, docs.schema)


def _mask(values: np.ndarray):
    import pyarrow as pa

    return pa.array(values)
