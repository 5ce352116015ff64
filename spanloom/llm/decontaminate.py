"""Benchmark passages in documents: greedy string tiling over shared-token seeds.

Benchmark items give seeds, runs of ``seed`` tokens; documents are scanned for them.  For an item
and a document that share enough seeds, the longest common runs of tokens that are not yet covered
are marked again and again (running Karp-Rabin finds them by seed hash, tokens confirm them), so a
passage is found even when its parts are in another order.  Coverage is the share of an item's
tokens that are marked.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, strings

SEED_TOKENS = 5
THRESHOLD = 0.6
#: Bytes of benchmark text in one block; a larger benchmark is scanned block by block.
BLOCK_BYTES = 4 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# lower-case letters, digits and everything beyond ASCII are token characters
_TOKEN = bytes(i if 48 <= i < 58 or 97 <= i < 123 or i >= 128 else 32 for i in range(256))


def tokens(text: str) -> list[bytes]:
    """Letters and digits in lower case; other ASCII characters only part them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TOKEN).split()


def seed_hashes(ids: np.ndarray, seed: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``seed`` token numbers."""
    n = len(ids) - seed + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = ids.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(seed):
        h = h * _FACTOR + wide[i:i + n]
    return h


class Block:
    """Part of the benchmark, ready to be scanned for."""

    def __init__(self, items: list[tuple[int | None, str]], seed: int = SEED_TOKENS):
        self.seed = seed
        self.numbers: dict[bytes, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        hashes, owners, places = [], [], []
        for item_id, text in items:
            words = tokens(text or "")
            ids = np.array(
                [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int64
            )
            h = seed_hashes(ids, seed)
            hashes.append(h)
            owners.append(np.full(len(h), len(self.items)))
            places.append(np.arange(len(h)))
            self.items.append((item_id, ids))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owners = (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]
        self.places = (np.concatenate(places) if places else np.zeros(0, np.int64))[order]
        self.distinct = np.unique(self.hashes)

    def number(self, words: list[bytes]) -> np.ndarray:
        """Token numbers; 0 for tokens of no item."""
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Where a seed of some item starts in a document."""
        h = seed_hashes(ids, self.seed)
        if not len(h) or not len(self.distinct):
            return np.zeros(0, np.int64)
        known = np.append(0, np.cumsum(ids > 0))
        full = np.flatnonzero(known[self.seed:] - known[:-self.seed] == self.seed)
        at = np.searchsorted(self.distinct, h[full])
        at[at == len(self.distinct)] = 0
        return full[self.distinct[at] == h[full]]


def tiles(item: np.ndarray, doc: np.ndarray, pairs: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (item start, document start, length), longest first, none overlapping.

    ``pairs`` are the (item, document) places where a seed agrees.
    """
    agree = np.ones(len(pairs), bool)
    for i in range(least):
        agree &= item[pairs[:, 0] + i] == doc[pairs[:, 1] + i]
    pairs = pairs[agree]
    # runs of pairs along a diagonal are one match
    diagonal = pairs[:, 1] - pairs[:, 0]
    order = np.lexsort((pairs[:, 0], diagonal))
    pairs, diagonal = pairs[order], diagonal[order]
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (diagonal[1:] != diagonal[:-1]) | (pairs[1:, 0] != pairs[:-1, 0] + 1)
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(pairs))) + least - 1
    waiting = [(-int(n), int(a), int(b)) for n, (a, b) in zip(sizes, pairs[starts], strict=True)]
    heapq.heapify(waiting)
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    out = []
    while waiting:
        size, a, b = heapq.heappop(waiting)
        size = -size
        taken = in_item[a:a + size] | in_doc[b:b + size]
        if not taken.any():
            out.append((a, b, size))
            in_item[a:a + size] = in_doc[b:b + size] = True
            continue
        # what is left of a match that another one has cut waits for its own turn
        edges = np.diff(np.concatenate(([1], taken, [1])).astype(np.int8))
        for s, e in zip(np.flatnonzero(edges == -1), np.flatnonzero(edges == 1), strict=True):
            if e - s >= least:
                heapq.heappush(waiting, (-int(e - s), a + int(s), b + int(s)))
    return out


def scan(block: Block, words: list[bytes], ids: np.ndarray, threshold: float) -> list[tuple]:
    """(item ID, coverage, tiles) of the items that a document covers to the threshold."""
    at = block.hits(ids)
    if not len(at):
        return []
    h = seed_hashes(ids, block.seed)[at]
    first = np.searchsorted(block.hashes, h, "left")
    count = np.searchsorted(block.hashes, h, "right") - first
    rows = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    where = np.repeat(at, count)
    owners, places = block.owners[rows], block.places[rows]
    out = []
    for owner in np.unique(owners):
        item_id, item = block.items[owner]
        mine = owners == owner
        # tokens under any shared seed: tiles cannot cover more
        under = np.zeros(len(item) + 1, np.int64)
        np.add.at(under, np.unique(places[mine]), 1)
        np.subtract.at(under, np.unique(places[mine]) + block.seed, 1)
        if (np.cumsum(under) > 0).sum() < threshold * len(item):
            continue
        found = tiles(item, ids, np.stack([places[mine], where[mine]], axis=1), block.seed)
        coverage = sum(n for _, _, n in found) / len(item)
        if coverage >= threshold:
            out.append((item_id, coverage, sorted(found, key=lambda t: t[1])))
    return out


def blocks(
    benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, id_column: str = "item_id",
    text_column: str = "text",
) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark in parts of at most ``block_bytes``, or of one item."""
    items = benchmark.select(
        F.col(id_column).cast("long").alias("item_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    size = F.sum(F.octet_length("text") + 16)
    parts = max(1, -(-(items.agg(size).first()[0] or 0) // block_bytes))
    while True:
        place = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
        per_part = items.groupBy(place.alias("p")).agg(
            size.alias("bytes"), F.countDistinct("item_id", "text").alias("n")
        )
        over = per_part.filter((F.col("bytes") > block_bytes) & (F.col("n") > 1))
        if over.limit(1).count() == 0:
            break
        parts *= 2
    for p in range(parts):
        yield [tuple(r) for r in items.filter(place == p).distinct().collect()]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, seed: int = SEED_TOKENS,
    block_bytes: int = BLOCK_BYTES, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, coverage, n_tiles, spans)`` for pairs covered to the threshold.

    ``spans`` lists document token ranges ``start:end``.  Items of fewer than ``seed`` tokens and
    null or empty texts have no seeds and match nothing.  Repeated items count once.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    schema = "doc_id long, item_id long, coverage double, n_tiles int, spans string"
    results = None
    for items in blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Batches, shared=shared) -> Iterator[dict]:
            block = Block(shared.value, seed)
            for batch in batches:
                found = []
                for i, text in zip(batch.column("id").to_pylist(), strings(batch.column("text")), strict=True):
                    words = tokens(text)
                    for item, coverage, t in scan(block, words, block.number(words), threshold):
                        spans = ",".join(f"{b}:{b + n}" for _, b, n in t)
                        found.append((i, item, coverage, len(t), spans))
                names = ["doc_id", "item_id", "coverage", "n_tiles", "spans"]
                columns = list(zip(*found, strict=True)) if found else [[]] * 5
                yield dict(zip(names, columns, strict=True))

        part = map_rows(rows, run, schema)
        results = part if results is None else results.unionByName(part)
    return results


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, seed: int = SEED_TOKENS,
    block_bytes: int = BLOCK_BYTES, text_column: str = "text",
) -> DataFrame:
    """Documents that no item covers to the threshold, all columns as they were."""
    import pyarrow as pa

    for items in blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Batches, shared=shared) -> Iterator:
            block = Block(shared.value, seed)
            for batch in batches:
                keep = []
                for text in strings(batch.column(text_column)):
                    words = tokens(text)
                    keep.append(not scan(block, words, block.number(words), threshold))
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
