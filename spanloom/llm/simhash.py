"""SimHash near-duplicates: vantage-point trees over sharded fingerprints.

A fingerprint has ``64 * lanes`` bits.  Lane 0 votes with the XXH64 (seed 42) of each word shingle,
further lanes with a mix of it.  Fingerprints link at ``radius`` or fewer differing bits.

Distances of unrelated 64-bit fingerprints crowd around 32, so a tree over all bits has to enter
nearly every branch.  Shards therefore hold fingerprints at Hamming distance 0 in two of six blocks
of a lane (fifteen block pairs, so neighbouring shards overlap): any two fingerprints with at most
four differing bits in a lane meet in one of them.  Within a shard a vantage-point tree finds the
pairs: branches farther than the radius beyond the dividing distance are never compared, and a
ball of half the radius is linked without comparing its points with each other.

One lane and radius 4 is exact.  With more lanes a pair is certain to meet as long as one lane has
at most four differing bits, that is up to ``5 * lanes - 1`` in total, and likely to beyond.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, run_bounds, sorted_runs, stored, strings
from spanloom.llm.components import components

SEED = 42
#: Bit positions where the six blocks of a lane end.
BLOCK_ENDS = (11, 22, 33, 43, 54, 64)
#: Runs up to this size are compared row against row; larger ones get a tree.
LEAF = 32
_VOTES_AT_ONCE = 1 << 15


def _mix(h: np.ndarray, lane: int) -> np.ndarray:
    """Another hash of the same shingle: the finaliser of splitmix64 on a shifted state."""
    z = h + np.uint64((lane * 0x9E3779B97F4A7C15) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; of the whole sequence if it has fewer words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = list(itertools.accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends[:-1]]
    count = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[min(words, len(tokens)) - 1:]
    return np.fromiter(
        (digest(joined[a:b - 1], SEED) for a, b in zip(starts[:count], last, strict=True)),
        np.uint64, count,
    )


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> list[int]:
    """One signed 64-bit number per lane; a bit is set if it is in over half the hashes."""
    out = []
    for lane in range(lanes):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), _VOTES_AT_ONCE):
            part = hashes[at:at + _VOTES_AT_ONCE]
            part = part if lane == 0 else _mix(part, lane)
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        packed = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
        out.append(int(packed.view(np.int64)[0]))
    return out


def fingerprints(
    docs: DataFrame, words: int = 4, lanes: int = 1, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, fp0 .. fp<lanes-1>)`` per row of ``docs``; null and empty texts have fingerprint 0."""
    names = [f"fp{i}" for i in range(lanes)]

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            made = [
                fingerprint(shingle_hashes(t, words), lanes)
                for t in strings(batch.column("text"))
            ]
            columns = list(zip(*made, strict=True)) if made else [[] for _ in names]
            yield {"id": batch.column("id"), **dict(zip(names, columns, strict=True))}

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    return map_rows(rows, run, "id long, " + ", ".join(f"{n} long" for n in names))


# ---------------------------------------------------------------- vantage-point trees


def distances(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ at).sum(axis=-1, dtype=np.int64)


def vantage_links(points: np.ndarray, radius: int, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Index pairs within ``radius`` whose connected sets are those of all pairs within it.

    ``points`` has a row per fingerprint and a column per lane.
    """
    links: list[tuple[int, int]] = []
    work: list[tuple[np.ndarray, np.ndarray | None]] = [(np.arange(len(points)), None)]
    while work:
        own, other = work.pop()
        if other is None:
            work += _grow(points, own, radius, leaf, links)
        elif len(own) and len(other):
            work += _cross(points, own, other, radius, leaf, links)
    return links


def _compare(points, left, right, radius, links) -> None:
    step = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), step):
        part = left[at:at + step]
        near = distances(points[part][:, None, :], points[right][None, :, :]) <= radius
        a, b = np.nonzero(near)
        links.extend(zip(part[a].tolist(), right[b].tolist(), strict=True))


def _grow(points, own, radius, leaf, links) -> list:
    """One node of a tree: vantage point, dividing distance, branches and their overlap."""
    if len(own) <= leaf:
        _compare(points, own, own, radius, links)
        return []
    far = distances(points[own], points[own[0]])
    near = own[far <= radius]
    links.extend((int(own[0]), int(x)) for x in near[1:])
    if 2 * far.max() <= radius:
        return []  # any two are within the radius through the vantage point
    middle = int(np.median(far))
    middle = middle if (far > middle).any() else middle - 1
    inside = far <= middle
    if not inside.any():
        _compare(points, own, own, radius, links)
        return []
    inner, outer = own[inside], own[~inside]
    overlap = (inner[far[inside] > middle - radius], outer[far[~inside] <= middle + radius])
    return [(inner, None), (outer, None), overlap]


def _cross(points, own, other, radius, leaf, links) -> list:
    """Pairs between two sets, divided by the distance from a point of the first."""
    if len(own) * len(other) <= leaf * leaf:
        _compare(points, own, other, radius, links)
        return []
    at = points[own[0]]
    far, far_other = distances(points[own], at), distances(points[other], at)
    keep = (far_other >= far.min() - radius) & (far_other <= far.max() + radius)
    other, far_other = other[keep], far_other[keep]
    if not len(other):
        return []
    if far.max() + far_other.max() <= radius:
        links.extend((int(own[0]), int(x)) for x in itertools.chain(own[1:], other))
        return []
    if far.min() == far.max():
        if len(own) > leaf and len(other) > 1 and far_other.min() < far_other.max():
            return [(other, own)]
        _compare(points, own, other, radius, links)
        return []
    middle = int(np.median(far))
    middle = middle if (far > middle).any() else middle - 1
    inside = far <= middle
    return [
        (own[inside], other[far_other <= middle + radius]),
        (own[~inside], other[far_other > middle - radius]),
    ]


def forest(n: int, links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, root) for the nodes of ``range(n)`` that links tie to a smaller one."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(x, r) for x in range(n) if (r := find(x)) != x]


# ---------------------------------------------------------------- shards


def _masks() -> list[int]:
    starts = (0, *BLOCK_ENDS[:-1])
    blocks = [(1 << e) - (1 << s) for s, e in zip(starts, BLOCK_ENDS, strict=True)]
    pairs = [a | b for a, b in itertools.combinations(blocks, 2)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in pairs]


def _shards(lanes: int) -> Column:
    keys = [
        F.struct(
            F.lit(lane * 100 + i).alias("shard"), F.col(f"fp{lane}").bitwiseAND(F.lit(m)).alias("at")
        )
        for lane in range(lanes) for i, m in enumerate(_masks())
    ]
    return F.explode(F.array(*keys))


def _linked(lanes: int, radius: int):
    names = [f"fp{i}" for i in range(lanes)]

    def run(batches: Batches) -> Iterator[dict]:
        for group in sorted_runs(batches, ["shard", "at"]):
            points = np.stack(
                [np.asarray(group.column(n)).view(np.uint64) for n in names], axis=1
            )
            bounds = run_bounds(group, ["shard", "at"])
            sizes = np.diff(bounds)
            run_of = np.repeat(np.arange(len(sizes)), sizes)
            small = np.repeat(sizes <= LEAF, sizes)
            found = [np.zeros((0, 2), np.int64)]
            for step in range(1, min(LEAF, int(sizes.max()))):
                left = np.flatnonzero((run_of[step:] == run_of[:-step]) & small[step:])
                near = left[distances(points[left], points[left + step]) <= radius]
                found.append(np.stack([near, near + step], axis=1))
            for r in np.flatnonzero(sizes > LEAF):
                own = points[bounds[r]:bounds[r + 1]]
                tied = forest(len(own), vantage_links(own, radius))
                if tied:
                    found.append(np.array(tied, np.int64) + bounds[r])
            pairs = np.concatenate(found)
            for at in range(0, len(pairs), 10_000):
                a, b = pairs[at:at + 10_000].T
                out = {}
                for side, rows in (("u", a), ("v", b)):
                    for i, n in enumerate(names):
                        out[side + n] = points[rows, i].view(np.int64)
                yield out

    return run


def links(prints: DataFrame, lanes: int, radius: int) -> DataFrame:
    """Links ``(u, v)`` between different fingerprints, as hexadecimal keys; not all links, but
    enough to tie together whatever all links tie together."""
    names = [f"fp{i}" for i in range(lanes)]
    sharded = prints.select(*names, _shards(lanes).alias("_s")).select("_s.shard", "_s.at", *names)
    dealt = sharded.repartition("shard", "at").sortWithinPartitions("shard", "at", *names)
    schema = ", ".join(f"{s}{n} long" for s in "uv" for n in names)
    pairs = map_rows(dealt, _linked(lanes, radius), schema)
    return pairs.select(*[key([F.col(s + n) for n in names]).alias(s) for s in "uv"])


def key(lanes: list[Column]) -> Column:
    """A fingerprint as hexadecimal digits, 16 for each lane."""
    return F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in lanes]))


def near_duplicates(
    docs: DataFrame, words: int = 4, lanes: int = 1, radius: int = 4, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row; the component's smallest ID names it.

    Rows with equal fingerprints are one point of the trees, whatever their number.  Null texts
    count as empty; empty texts have fingerprint 0 and link like any other.  Repeated IDs give
    repeated rows.  A null ID never names a component unless it has no other member.
    """
    names = [f"fp{i}" for i in range(lanes)]
    prints = stored(fingerprints(docs, words, lanes, id_column, text_column), "prints")
    keyed = prints.withColumn("fingerprint", key([F.col(n) for n in names]))
    points = stored(
        keyed.groupBy("fingerprint", *names).agg(F.min("id").alias("first_id")), "points"
    )
    roots = components(links(points, lanes, radius))
    rooted = points.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = stored(rooted, "rooted")
    named = stored(
        rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "named"
    )
    classes = stored(
        rooted.join(named, "root").select(F.col("fingerprint").alias("point"), "component_id"),
        "classes",
    )
    return keyed.join(classes, F.col("fingerprint") == F.col("point"), "left").select(
        "id", "fingerprint", "component_id"
    )


def lanes_radius(similarity: float, lanes: int) -> int:
    """Differing bits expected between two shingle sets of this Jaccard similarity."""
    cosine = 2 * similarity / (1 + similarity)
    return round(64 * lanes * float(np.arccos(cosine)) / np.pi)
