"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraph pieces: lines, cut again behind words that end a sentence and, where
neither comes, every ``PIECE_WORDS`` words.  The digest of each piece, made distinct by its number
among equal ones, goes into three cells of a sketch; a cell holds a count, the sum of its digests
and the sum of their checks, both modulo 2^64.  Two sketches of one size subtract cell by cell;
what both hold vanishes, and cells with a single digest left are peeled until nothing remains.  If
peeling gets stuck, both sketches are made again with twice the cells.

All pairs of a batch are peeled side by side in flat arrays.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows

PIECE_WORDS = 8
CELLS = 24
HASHES = 3
_ENDS = (".", "!", "?")


def pieces(text: str) -> list[str]:
    """Paragraph pieces of a whole text, white space at their ends left out."""
    out = []
    for line in text.split("\n"):
        words = line.split()
        start = 0
        for i, w in enumerate(words, 1):
            if i - start == PIECE_WORDS or w[-1] in _ENDS:
                out.append(" ".join(words[start:i]))
                start = i
        if start < len(words):
            out.append(" ".join(words[start:]))
    return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    z = x + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Digests:
    """Piece digests of many texts, one after the other."""

    def __init__(self, texts: list[str]):
        digest = xxhash.xxh64_intdigest
        lists = [[digest(p.encode("utf-8", "replace")) for p in pieces(t)] for t in texts]
        self.counts = np.array([len(x) for x in lists], np.int64)
        raw = np.array([d for x in lists for d in x], np.uint64)
        owner = np.repeat(np.arange(len(lists)), self.counts)
        order = np.lexsort((raw, owner))
        raw, owner = raw[order], owner[order]
        again = np.zeros(len(raw), bool)
        again[1:] = (raw[1:] == raw[:-1]) & (owner[1:] == owner[:-1])
        index = np.arange(len(raw))
        nth = index - np.maximum.accumulate(np.where(again, 0, index)) if len(raw) else index
        self.values = np.where(nth > 0, _mix(raw + nth.astype(np.uint64), 77), raw)
        self.owner = owner

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digests of some texts, and for each the place of its text in ``rows``."""
        begin = np.append(0, np.cumsum(self.counts))
        n = self.counts[rows]
        place = np.repeat(np.arange(len(rows)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.values[np.repeat(begin[rows], n) + offset], place


def _places(values: np.ndarray, base: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The three cells of each digest; each lies in its own third of the sketch."""
    third = (cells // HASHES).astype(np.uint64)
    out = np.empty((HASHES, len(values)), np.int64)
    for i in range(HASHES):
        out[i] = base + i * (cells // HASHES) + (_mix(values, i + 1) % third).astype(np.int64)
    return out


class Cells:
    """Sketches of equal or different sizes in one flat array."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self.base = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        self.count = np.zeros(total, np.int64)
        self.key = np.zeros(total, np.uint64)
        self.check = np.zeros(total, np.uint64)

    def add(self, values: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
        """Insert (+1) or take out (-1) digests; sums wrap around."""
        check = _mix(values, 99)
        up = sign > 0
        for at in _places(values, self.base[place], self.sizes[place]):
            np.add.at(self.count, at, sign)
            for cells, v in ((self.key, values), (self.check, check)):
                np.add.at(cells, at[up], v[up])
                np.subtract.at(cells, at[~up], v[~up])

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """Digests recovered per sketch, and whether the sketch came out empty."""
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        recovered = np.zeros(len(self.sizes), np.int64)
        left = int(np.count_nonzero(self.count)) + 1
        rounds = 0
        while left and rounds < 10_000:
            rounds += 1
            one = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[one]
            value = np.where(sign > 0, self.key[one], np.uint64(0) - self.key[one])
            check = np.where(sign > 0, self.check[one], np.uint64(0) - self.check[one])
            pure = _mix(value, 99) == check
            place, value, sign = owner[one][pure], value[pure], sign[pure]
            # a digest may show in several of its cells at once
            _, first = np.unique(np.stack([place.astype(np.uint64), value]), axis=1, return_index=True)
            place, value, sign = place[first], value[first], sign[first]
            left = len(value)
            if left:
                np.add.at(recovered, place, 1)
                self.add(value, place, -sign)
        dirty = (self.count != 0) | (self.key != 0) | (self.check != 0)
        clean = np.ones(len(self.sizes), bool)
        clean[owner[dirty]] = False
        return recovered, clean


def differing(left: Digests, a: np.ndarray, right: Digests, b: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """How many digests differ between text ``a[i]`` of one list and ``b[i]`` of another."""
    out = np.zeros(len(a), np.int64)
    open_pairs = np.arange(len(a))
    while len(open_pairs):
        # bounded arrays, however large the sketches have become
        step = max(1, (1 << 21) // cells)
        failed = []
        for at in range(0, len(open_pairs), step):
            some = open_pairs[at:at + step]
            sketch = Cells(np.full(len(some), cells))
            for digests, rows, sign in ((left, a, 1), (right, b, -1)):
                values, place = digests.take(rows[some])
                sketch.add(values, place, np.full(len(values), sign))
            recovered, clean = sketch.peel()
            out[some[clean]] = recovered[clean]
            failed.append(some[~clean])
        open_pairs = np.concatenate(failed)
        cells *= 2
    return out


def likeness(left: Digests, a: np.ndarray, right: Digests, b: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Pieces in both by pieces in either, repeats counted; 1 for two empty texts."""
    apart = differing(left, a, right, b, cells)
    total = left.counts[a] + right.counts[b]
    either = (total + apart) / 2
    return np.where(either > 0, (total - apart) / 2 / np.maximum(either, 1), 1.0)


def sketches(digests: Digests, cells: int = CELLS) -> list[str]:
    """Base sketches as text: cells one after the other, base64."""
    n = len(digests.counts)
    sketch = Cells(np.full(n, cells))
    values, place = digests.take(np.arange(n))
    sketch.add(values, place, np.ones(len(values), np.int64))
    record = np.zeros((n, cells), dtype=[("count", "<i4"), ("key", "<u8"), ("check", "<u8")])
    for name in ("count", "key", "check"):
        record[name] = getattr(sketch, name).reshape(n, cells)
    return [base64.b64encode(x.tobytes()).decode() for x in record]


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of another text."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


# ---------------------------------------------------------------- neighbours in ID order


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows dealt to ID ranges and sorted downwards, each range followed by the row after it.

    The bounds are quantiles of the IDs, as many as there are ranges; the first row of a range is
    also sent to the range before it (``guest``), the first of all to the last.  Texts move once.
    Columns: ``part``, ``id``, ``text``, ``guest``.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    levels = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("id", levels, 100 * ranges)).first()[0] or []
    bounds = sorted(set(found))
    # a null ID sorts behind all others
    below = F.array(*[F.lit(x) for x in bounds]) if bounds else F.array().cast("array<bigint>")
    part = F.when(F.col("id").isNull(), 0).otherwise(
        F.size(F.filter(below, lambda x: x < F.col("id"))) + 1
    )
    placed = rows.withColumn("part", part.cast("int"))
    return _with_guests(placed)


def _with_guests(placed: DataFrame) -> DataFrame:
    """Send the first row of each part to the part before it as well."""
    rank = F.struct(
        F.col("id").isNotNull().alias("known"), F.col("id"), F.xxhash64("text").alias("h"), F.length("text").alias("n")
    )
    heads = placed.groupBy("part").agg(F.max(rank).alias("head")).orderBy(F.desc("part")).collect()
    pairs = []
    for i, row in enumerate(heads):
        before = heads[i - 1]["part"]  # of the first part this is the last one
        pairs.append((row["part"], row["head"]["id"], row["head"]["h"], row["head"]["n"], before))
    spark = placed.sparkSession
    table = F.broadcast(spark.createDataFrame(
        pairs, "part int, head_id long, head_h long, head_n int, before int"
    ))
    joined = placed.join(table, "part")
    is_head = (
        F.col("id").eqNullSafe(F.col("head_id")) & (F.xxhash64("text") == F.col("head_h"))
        & (F.length("text") == F.col("head_n"))
    )
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("part"), F.lit(True).alias("guest"))
    targets = F.when(is_head, F.array(own, guest)).otherwise(F.array(own))
    spread = joined.select("id", "text", F.explode(targets).alias("_t"))
    spread = spread.select("_t.part", "id", "text", "_t.guest")
    return spread.repartition("part").sortWithinPartitions(
        "part", "guest", F.desc_nulls_last("id"), F.xxhash64("text").desc(), F.length("text").desc()
    )


def _neighbours(batches: Batches) -> Iterator[tuple[list, list[str], list[str]]]:
    """IDs, texts and following texts, in pieces of a batch."""
    ids: list = []
    texts: list[str] = []
    part, closed = None, False
    for batch in batches:
        done_ids, done, after = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("part", "id", "text", "guest"))
        for p, i, t, guest in zip(*columns, strict=True):
            if p != part:
                part, closed = p, False
                ids, texts = [], []
            if closed:
                continue  # equal first rows were sent more than once
            if texts:
                done_ids.append(ids[0])
                done.append(texts[0])
                after.append(t)
            ids, texts, closed = [i], [t], guest
        if done:
            yield done_ids, done, after


def edited_fingerprints(docs: DataFrame, cells: int = CELLS, ranges: int | None = None) -> DataFrame:
    """Each text, its edited form and the likeness of their sketches.

    The next document is the one with the next smaller ID; after the smallest comes the largest.
    Null texts count as empty.  Rows of equal IDs follow each other by text hash, a null ID comes
    last.  The only document is its own next one.
    """

    def run(batches: Batches) -> Iterator[dict]:
        for ids, texts, after in _neighbours(batches):
            changed = [edited(t, a) for t, a in zip(texts, after, strict=True)]
            n = len(texts)
            own, new = Digests(texts), Digests(changed)
            following = Digests(after)
            rows = np.arange(n)
            yield {
                "doc_id": pa.array(ids, pa.int64()),
                "n_chars": [len(t) for t in texts],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed],
                "fingerprint": sketches(own, cells),
                "edited_fingerprint": sketches(new, cells),
                "near_edited": likeness(own, rows, new, rows, cells),
                "near_next": likeness(own, rows, following, rows, cells),
            }

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_rows(with_next(docs, ranges), run, schema)
