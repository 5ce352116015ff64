"""Passages that documents share: collinear chains of k-mer seeds, then alignment.

Seeds are word k-mers that are the smallest by hash in some window (any shared run of
``k + window - 1`` words shares one).  All places of a seed are tied to its first one, the anchor,
so a seed in n documents gives n - 1 matches.  The matches of a document with one anchor document
are chained in order of both positions, a Fenwick tree holding the best chain so far, and gaps cost.

Parts of a passage may first stand in different documents.  Seeds that no chain of a whole passage takes up
therefore go on in runs: a seed with one of those that follow it.  Documents that share a run are all compared
with each other where they are few.  Where they are many, the run grows by a further seed and is dealt anew, until
few have it or it is as long as a passage; then its first document stands for them.

Chains are aligned word by word; the ends go on past single edits, as long as more words agree than not.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, run_bounds, sorted_runs, stored, strings

K, WINDOW = 4, 10
#: Places of a run that are all compared with each other.
LEAF = 16
#: Which of the next seeds may be the second of a run; a run grows by the next seed alone, so its rows stay linear.
FOLLOWING = 4
#: Words between the first and the last seed of a chain that is aligned.
SHOWN = 12
#: Words at either end of a chain in which its passage may go on.
MARGIN = 60
#: What an edit costs at the ends, where an agreeing word gains 1, and how far the sum may fall.
EDIT, DROP = 2, 8
#: What a word of a gap costs, on either side; a seed is worth its k words.
GAP_COST = 0.05
MIN_WORDS = 50
MIN_IDENTITY = 0.8
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MEMORY = 500_000
_BLANK = r"[\x20\x09-\x0D]+"


class _Hashes(dict):
    """XXH64 of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def words_of(text: str) -> list[bytes]:
    """Words as ASCII white space parts them, in lower case."""
    return text.lower().encode("utf-8", "surrogatepass").split()


def seeds(h: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the minimal k-mers of every window; equal ones all count."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mers = np.zeros(n, np.uint64)
    for i in range(k):
        mers = mers * _FACTOR + h[i:i + n]
    mers = (mers ^ (mers >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mers ^= mers >> np.uint64(32)
    window = min(window, n)
    count = n - window + 1
    least = mers[:count].copy()
    for i in range(1, window):
        np.minimum(least, mers[i:i + count], out=least)
    chosen = np.zeros(n, bool)
    for i in range(window):
        chosen[i:i + count] |= mers[i:i + count] == least
    at = np.flatnonzero(chosen)
    return mers[at].view(np.int64), at


def seed_table(docs: DataFrame, k: int, window: int, id_column: str, text_column: str) -> DataFrame:
    def run(batches: Batches) -> Iterator[dict]:
        known = _Hashes()
        for batch in batches:
            made, places, sizes = [], [], []
            for text in strings(batch.column("text")):
                words = words_of(text)
                h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                s, at = seeds(h, k, window)
                made.append(s)
                places.append(at)
                sizes.append(len(s))
            ids = np.repeat(np.array(batch.column("id").to_pylist(), np.int64), sizes)
            s, at = np.concatenate(made), np.concatenate(places)
            for i in range(0, len(s), 50_000):
                yield {"seed": s[i:i + 50_000], "id": ids[i:i + 50_000], "at": at[i:i + 50_000].astype(np.int32)}

    rows = docs.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    return map_rows(rows, run, "seed long, id long, at int")


# ---------------------------------------------------------------- chains


def chain(x: np.ndarray, y: np.ndarray, k: int = K, gap_cost: float = GAP_COST) -> list[list[int]]:
    """Chains of matches (rows sorted by x, then y), best first, no match in two of them.

    A chain rises in both coordinates and is worth k per match less the gap cost of each word
    between matches on either side.  With the cost moved to the coordinates the best predecessor is
    a prefix maximum over y, which the Fenwick tree answers.
    """
    n = len(x)
    ranks = np.unique(y, return_inverse=True)[1] + 1
    size = int(ranks.max())
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)
    score, previous = [0.0] * n, [-1] * n
    xs, ys, rs = x.tolist(), y.tolist(), ranks.tolist()
    at = 0
    while at < n:
        end = at
        while end < n and xs[end] == xs[at]:
            end += 1
        for i in range(at, end):
            best, r = (-np.inf, -1), rs[i] - 1
            while r > 0:
                if tree[r] > best:
                    best = tree[r]
                r -= r & -r
            gained = best[0] - gap_cost * (xs[i] + ys[i] - 2 * k)
            if gained > 0:
                score[i], previous[i] = k + gained, best[1]
            else:
                score[i] = float(k)
        # matches of one place are no predecessors of each other
        for i in range(at, end):
            entry, r = (score[i] + gap_cost * (xs[i] + ys[i]), i), rs[i]
            while r <= size:
                if entry > tree[r]:
                    tree[r] = entry
                r += r & -r
        at = end
    used = [False] * n
    out = []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        if used[i]:
            continue
        members = []
        while i >= 0 and not used[i]:
            used[i] = True
            members.append(i)
            i = previous[i]
        out.append(members[::-1])
    return out


def _chained(k: int, gap_cost: float, min_words: int):
    """Chains of each pair of documents, and the seeds that are in no chain as long as a passage.

    A chain has its places in ``x`` and ``y``; a row of seeds left has them in ``x`` and ``seeds``.
    """
    shown = max(k, min(SHOWN, min_words))
    columns = ("id", "anchor_id", "x", "y", "seeds")

    def run(batches: Batches) -> Iterator[dict]:
        keys = ["id", "anchor_id"]
        for group in sorted_runs(batches, keys):
            bounds = run_bounds(group, keys).tolist()
            ids, anchors = (group.column(c).to_pylist() for c in keys)
            x, y = (np.asarray(group.column(c)).astype(np.int64) for c in ("at", "anchor_at"))
            seed = np.asarray(group.column("seed"))
            out: dict[str, list] = {c: [] for c in columns}

            def put(*values):
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)

            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                own, other = ids[a], anchors[a]
                left = np.ones(b - a, bool)
                if own != other and x[b - 1] - x[a] + k >= shown:
                    for members in chain(x[a:b], y[a:b], k, gap_cost):
                        cx, cy = x[a:b][members], y[a:b][members]
                        length = min(cx[-1] - cx[0], cy[-1] - cy[0]) + k
                        if length >= shown:
                            put(own, other, cx.tolist(), cy.tolist(), None)
                        if length >= min_words:
                            left[members] = False
                if left.any():
                    put(own, other, x[a:b][left].tolist(), None, seed[a:b][left].tolist())
            yield out

    return run


def _tied(places: DataFrame) -> DataFrame:
    """Each ``(seed, id, at)`` with the first place of the seed.

    Further places in the first document come tied to it as well, and belong to no chain.  The first places are
    a partial aggregate; the join with them starts from scans or shuffles, so adaptive execution may split a
    seed with very many places.
    """
    first = places.groupBy("seed").agg(
        F.min(F.struct("id", "at")).alias("first"), F.max("id").alias("last_id")
    ).filter("first.id < last_id")
    anchors = stored(
        first.select(
            F.col("seed").alias("_seed"), F.col("first.id").alias("anchor_id"),
            F.col("first.at").alias("anchor_at"),
        ), "anchors",
    )
    return places.join(anchors, F.col("seed") == F.col("_seed")).filter(
        "id != anchor_id OR at != anchor_at"
    ).select("seed", "id", "anchor_id", "at", "anchor_at")


def _grown(runs: DataFrame, places: DataFrame, steps: int, far: int) -> DataFrame:
    """Runs with one more seed, each of the next ``steps`` places that is within ``far`` words."""
    step = F.explode(F.sequence(F.lit(1), F.lit(steps)))
    longer = runs.withColumn("_step", step).withColumn("_to", F.col("no") + F.col("_step"))
    following = places.select(
        F.col("id").alias("_id"), F.col("no").alias("_no"), F.col("at").alias("_at"), F.col("seed").alias("_seed")
    )
    joined = longer.join(following, (F.col("id") == F.col("_id")) & (F.col("_to") == F.col("_no")))
    gap = F.col("_at") - F.element_at("ats", -1)
    return joined.filter((gap > 0) & (gap <= far)).select(
        F.xxhash64("run", "_seed").alias("run"), "id", F.concat("ats", F.array("_at")).alias("ats"),
        F.col("_no").alias("no"),
    )


def _shared_runs(left: DataFrame, k: int, min_words: int) -> DataFrame:
    """``(id, anchor_id, at, anchor_at)`` of the seeds left, for documents that share a run of two or more.

    ``left`` has ``seed, id, at``.  A single seed makes no chain, so runs begin with two.
    """
    order = Window.partitionBy("id").orderBy("at", "seed")
    left = stored(left.distinct(), "left")
    shared = left.groupBy("seed").agg(F.min("id").alias("_low"), F.max("id").alias("_high")).filter("_low < _high")
    places = stored(
        left.join(shared.select("seed"), "seed", "left_semi").select(
            "seed", "id", "at", F.row_number().over(order).alias("no")
        ), "places",
    )
    single = places.select(F.col("seed").alias("run"), "id", F.array("at").alias("ats"), "no")
    # text that repeats itself within a passage's length has a run once there
    start = F.get("ats", F.lit(0))
    before = F.lag(start).over(Window.partitionBy("run", "id").orderBy(start, "no"))
    runs = stored(
        _grown(single, places, FOLLOWING, min_words).withColumn("_before", before).filter(
            F.col("_before").isNull() | (start - F.col("_before") >= min_words)
        ).drop("_before"), "runs",
    )
    schema = "id long, anchor_id long, at int, anchor_at int"
    found = [left.sparkSession.createDataFrame([], schema)]

    def matches(pairs: DataFrame) -> DataFrame:
        both = F.explode(F.arrays_zip("ats", "anchor_ats")).alias("_both")
        return pairs.select("id", "anchor_id", both).select(
            "id", "anchor_id", F.col("_both.ats").alias("at"), F.col("_both.anchor_ats").alias("anchor_at")
        )

    while not runs.isEmpty():
        groups = runs.groupBy("run").agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("_low"), F.max("id").alias("_high")
        ).filter("_low < _high").select(F.col("run").alias("_run"), "n")
        known = stored(runs.join(groups, F.col("run") == F.col("_run")).drop("_run"), "known")
        few = known.filter(F.col("n") <= LEAF).groupBy("run").agg(
            F.sort_array(F.collect_list(F.struct("id", "ats"))).alias("one")
        )
        pairs = few.select("one", F.explode("one").alias("other")).select(
            F.explode(F.filter("one", lambda x: x["id"] < F.col("other.id"))).alias("one"), "other"
        ).select(
            F.col("other.id").alias("id"), F.col("one.id").alias("anchor_id"), F.col("other.ats").alias("ats"),
            F.col("one.ats").alias("anchor_ats"),
        )
        many = known.filter(F.col("n") > LEAF).drop("n")
        whole = F.element_at("ats", -1) - F.get("ats", F.lit(0)) + k >= min_words
        first = many.filter(whole).groupBy("run").agg(F.min(F.struct("id", "ats")).alias("first"))
        tied = many.filter(whole).join(first, "run").filter(F.col("id") != F.col("first.id")).select(
            "id", F.col("first.id").alias("anchor_id"), "ats", F.col("first.ats").alias("anchor_ats")
        )
        found.append(stored(matches(pairs.union(tied)).distinct(), "matches"))
        runs = stored(_grown(many.filter(~whole), places, 1, min_words), "runs")
    return reduce(DataFrame.union, found).distinct()


# ---------------------------------------------------------------- alignment


def _run(a: list[str], b: list[str], i: int, j: int, most: int) -> int:
    n = 0
    while n < most and i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n


def extend(a: list[str], b: list[str]) -> tuple[int, int, int]:
    """How many words of both lists belong to a passage that begins at their heads, and how many agree.

    An edit is a word replaced, left out or put in, whichever lets most of the next words agree.  The best sum
    of gains and costs counts; the search ends once the sum fell by ``DROP``.
    """
    i = j = agree = score = 0
    best = (0, 0, 0, 0)
    while True:
        n = _run(a, b, i, j, max(len(a), len(b)))
        i, j, agree, score = i + n, j + n, agree + n, score + n
        if score > best[0]:
            best = (score, i, j, agree)
        if i >= len(a) or j >= len(b) or score <= best[0] - DROP:
            return best[1:]
        _, one, other = max(
            (_run(a, b, i + p, j + q, 4), p, q) for p, q in ((1, 1), (0, 1), (1, 0))
        )
        i, j, score = i + one, j + other, score - EDIT


def align(a: list[str], b: list[str], x: list[int], y: list[int], k: int = K) -> tuple[int, int, int, int, int]:
    """Start and end in both word lists and how many words agree, from a chain's places.

    Between seeds the words are compared in step if both gaps have one length, otherwise by the
    longest blocks they share; at the ends the passage goes on past edits.
    """
    back, back_other, before = extend(a[:x[0]][::-1], b[:y[0]][::-1])
    on, on_other, after = extend(a[x[-1]:], b[y[-1]:])
    agree = before + after
    for i in range(len(x) - 1):
        p, q = a[x[i]:x[i + 1]], b[y[i]:y[i + 1]]
        if len(p) == len(q):
            agree += sum(map(str.__eq__, p, q))
        else:
            blocks = SequenceMatcher(None, p, q, autojunk=False).get_matching_blocks()
            agree += sum(m.size for m in blocks)
    return x[0] - back, x[-1] + on, y[0] - back_other, y[-1] + on_other, agree


def _aligned(k: int, margin: int, min_words: int, min_identity: float):
    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {
                c: [] for c in ("doc_id", "start", "end", "anchor_id", "anchor_start", "anchor_end", "identity")
            }
            columns = (batch.column(c).to_pylist() for c in ("id", "anchor_id", "x", "y", "left", "right"))
            for i, other, x, y, left, right in zip(*columns, strict=True):
                from_x, from_y = max(0, x[0] - margin), max(0, y[0] - margin)
                s, e, t, f, agree = align(
                    left.split(" "), right.split(" "), [v - from_x for v in x], [v - from_y for v in y], k
                )
                identity = agree / max(e - s, f - t, 1)
                if min(e - s, f - t) >= min_words and identity >= min_identity:
                    values = (i, s + from_x, e + from_x, other, t + from_y, f + from_y, identity)
                    for c, v in zip(out.values(), values, strict=True):
                        c.append(v)
            yield out

    return run


def _sliced(chains: DataFrame, docs: DataFrame, key: str, places: str, margin: int, k: int, name: str) -> DataFrame:
    """Add the words around a chain on one side, joined by single spaces."""
    texts = docs.select(F.col("id").alias("_id"), "text")
    words = F.split(F.regexp_replace(F.lower("text"), f"^{_BLANK}", ""), _BLANK)
    first = F.greatest(F.lit(0), F.get(F.col(places), F.lit(0)) - margin)
    last = F.element_at(places, -1) + k + margin
    cut = F.array_join(F.slice(words, first + 1, last - first), " ")
    joined = chains.join(texts, F.col(key) == F.col("_id"))
    return joined.withColumn(name, cut).drop("_id", "text")


def shared_passages(
    docs: DataFrame, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS,
    min_identity: float = MIN_IDENTITY, gap_cost: float = GAP_COST, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Passages of ``min_words`` or more that a document shares with an earlier one.

    Columns: ``doc_id, start, end, anchor_id, anchor_start, anchor_end, identity``; places are word
    numbers, ends exclusive.  The anchor is the document with the smallest ID that holds a seed, so
    a passage of n documents gives n - 1 rows (more if its parts first stand in several documents, or if its
    seeds lie less than ``min_words`` apart: such seeds go on in runs).
    Null IDs take no part, null and short texts share nothing.  Rows of one ID count as one document;
    its passages come once.
    """
    rows = docs.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(text_column, F.lit("")).alias("text")
    )
    places = stored(seed_table(docs, k, window, id_column, text_column), "seeds")

    def chained(tied: DataFrame) -> DataFrame:
        dealt = tied.repartition("id", "anchor_id").sortWithinPartitions("id", "anchor_id", "at", "anchor_at")
        return stored(
            map_rows(
                dealt, _chained(k, gap_cost, min_words),
                "id long, anchor_id long, x array<int>, y array<int>, seeds array<long>",
            ), "chains",
        )

    first = chained(_tied(places))
    left = first.filter("seeds IS NOT NULL").select(
        "id", F.explode(F.arrays_zip("seeds", "x")).alias("_place")
    ).select(F.col("_place.seeds").alias("seed"), "id", F.col("_place.x").alias("at"))
    further = chained(_shared_runs(left, k, min_words).withColumn("seed", F.lit(0).cast("long")))
    chains = first.union(further).filter("seeds IS NULL").drop("seeds")
    with_left = _sliced(chains, rows, "id", "x", MARGIN, k, "left")
    both = _sliced(stored(with_left, "chains"), rows, "anchor_id", "y", MARGIN, k, "right")
    return map_rows(
        both, _aligned(k, MARGIN, min_words, min_identity),
        "doc_id long, start int, end int, anchor_id long, anchor_start int, anchor_end int, identity double",
    ).distinct()
