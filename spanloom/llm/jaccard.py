"""Near-duplicates by exact Jaccard similarity of word shingles: operator 1, then what it cannot reach.

Operator 1 (``simhash``: fingerprints, shards, vantage-point trees) groups texts whose fingerprints are close.
Each set of a group is compared exactly with the group's centre, the set nearest to the majority of
the group's bits; similar ones are linked.  A fingerprint cannot decide a Jaccard similarity, so all
other pairs are found by prefixes:

Two sets of similarity ``t`` or more share a member among the first ``n - ceil(t * n) + 1`` of each,
in any order of all members that both follow.  Those prefixes are the candidate route, so no link is
missed; every candidate is then decided on the whole sets.  The order puts members that a sample
shows to be common last: it decides how many candidates there are, never which links.

Pairs of a bucket (sets with one prefix member) are all candidates up to ``LEAF`` sets.  Members of
larger buckets go last in the order, and the sets of those buckets are dealt anew by it, ``DEALS`` times in
all.  What is still a larger bucket then holds sets that are mostly made of common members.  Its sets are
compared with one centre and dealt by what sets them apart from it (``_rest``): two sets differ in
the members in which these differences differ.

Whole sets move for pairs that sizes and parity sketches allow, a few partners a set at a time; pairs that
are connected meanwhile are not compared any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm import simhash
from spanloom.llm.common import Batches, map_rows, run_bounds, sorted_runs, stored, strings
from spanloom.llm.components import components
from spanloom.llm.simhash import shingle_hashes

LEAF = 8
#: Bits of a parity sketch; two sets differ in at least as many members as their sketches in bits.
PARITY = 2048
#: One of so many texts is looked at for common shingles, of which so many are remembered.
SAMPLED, COMMON = 32, 200_000
#: How often sets are dealt to buckets; each time the members of larger buckets go behind the others.
DEALS = 3
#: Partners of a set that are compared in a round, and the growth of their number.
PARTNERS, MORE_PARTNERS = 8, 8
#: Differing bits at which operator 1 links fingerprints; exact for one lane.
RADIUS = 4
#: Rows of a bucket that are compared with others at once.
_BLOCK = 256
_SEEN = 200_000


def shingle_set(text: str, words: int) -> np.ndarray:
    """Distinct hashes of the shingles, sorted."""
    return np.unique(shingle_hashes(text, words))


def point_of(members: np.ndarray) -> int:
    """A signed 64-bit name of a set; equal sets are one point."""
    h = xxhash.xxh64_intdigest(members.tobytes())
    return h - (1 << 64) if h >= 1 << 63 else h


def exact(similarity: float) -> Fraction:
    """The limit as it is written: 0.8 is 4/5."""
    return Fraction(str(similarity))


def prefix_size(n: int, limit: Fraction) -> int:
    return n - -(-n * limit.numerator // limit.denominator) + 1 if n else 0


def _among(members: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which members a sorted array holds."""
    if not len(of):
        return np.zeros(len(members), bool)
    return of[np.minimum(np.searchsorted(of, members), len(of) - 1)] == members


def prefix(
    members: np.ndarray, common: np.ndarray, limit: Fraction, counts: np.ndarray | None = None
) -> np.ndarray:
    """The first members in the order (count, hash); only common members have a count."""
    size = prefix_size(len(members), limit)
    known = _among(members, common)
    weight = known.astype(np.int64)
    if counts is not None:
        weight[known] = counts[np.searchsorted(common, members[known])]
    return members[np.argsort(weight, kind="stable")][:size]


class Order(NamedTuple):
    """Common members, sorted, with how often they were met; all others come first, by hash."""

    members: np.ndarray
    counts: np.ndarray

    def prefix(self, members: np.ndarray, limit: Fraction) -> np.ndarray:
        return prefix(members, self.members, limit, self.counts)

    def with_more(self, members: np.ndarray, counts: np.ndarray) -> Order:
        every = np.concatenate([self.members, members])
        most = np.concatenate([self.counts, counts])
        place = np.lexsort((-most, every))
        every, first = np.unique(every[place], return_index=True)
        return Order(every, most[place][first])


def similar(a: np.ndarray, b: np.ndarray, limit: Fraction) -> bool:
    """Jaccard similarity in whole numbers; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * limit.denominator >= (len(a) + len(b) - both) * limit.numerator


def parity(members: np.ndarray) -> bytes:
    """A bit is set if an odd number of members fall on it."""
    counts = np.bincount((members % np.uint64(PARITY)).astype(np.int64), minlength=PARITY)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _common(rows: DataFrame, words: int) -> Order:
    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            for text in strings(batch.column("text")):
                yield {"seed": shingle_set(text, words).view(np.int64)}

    sampled = rows.filter(F.pmod(F.xxhash64("id", F.length("text")), F.lit(SAMPLED)) == 0)
    counted = map_rows(sampled, run, "seed long").groupBy("seed").count().filter("count > 1")
    found = counted.orderBy(F.desc("count"), "seed").limit(COMMON).toArrow()
    return _order(Order(np.zeros(0, np.uint64), np.zeros(0, np.int64)), found, SAMPLED)


def _order(before: Order, found: pa.Table, each: int) -> Order:
    seeds, counts = (found.column(c).to_numpy() for c in ("seed", "count"))
    return before.with_more(seeds.view(np.uint64), counts * each)


def _dealt(
    rows: DataFrame, words: int, limit: Fraction, order: Order,
    busy: tuple[Order, np.ndarray] | None = None,
) -> DataFrame:
    """``(seed, size, point, place)`` for the prefix of every text; copies seen by a task come once.

    ``busy`` holds the order of the last deal and the members whose buckets were too large in it: only sets
    of those buckets are dealt.
    """
    shared = rows.sparkSession.sparkContext.broadcast((order, busy))

    def run(batches: Batches) -> Iterator[dict]:
        order, busy = shared.value
        seen: set[int] = set()
        for batch in batches:
            seeds, sizes, points, places = [], [], [], []
            for text in strings(batch.column("text")):
                members = shingle_set(text, words)
                if busy and not _among(busy[0].prefix(members, limit), busy[1]).any():
                    continue
                point = point_of(members)
                if point in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(point)
                own = order.prefix(members, limit).view(np.int64)
                seeds.append(own)
                sizes.append(np.full(len(own), len(members), np.int32))
                points.append(np.full(len(own), point, np.int64))
                places.append(np.arange(len(own), dtype=np.int32))
            if seeds:
                yield {
                    "seed": np.concatenate(seeds), "size": np.concatenate(sizes),
                    "point": np.concatenate(points), "place": np.concatenate(places),
                }

    return map_rows(rows, run, "seed long, size int, point long, place int")


def _deal(rows: DataFrame, words: int, limit: Fraction) -> tuple[DataFrame, Order]:
    """Candidates of all deals, stored, and the last order.

    Rows without a ``seed`` are pairs ``(u, v)`` of small buckets; the others are the sets ``u`` of larger ones.
    A deal passes on the members of its ``COMMON`` largest buckets; buckets beyond those stay as they are.
    """
    order, busy, out = _common(rows, words), None, []
    for deal in range(DEALS):
        dealt = _dealt(rows, words, limit, order, busy).repartition("seed")
        found = stored(
            map_rows(
                dealt.sortWithinPartitions("seed", "size", "point"), _candidates(limit), "seed long, u long, v long",
            ), "candidates",
        )
        counted = found.filter("seed IS NOT NULL").groupBy("seed").count()
        again = stored(counted.orderBy(F.desc("count"), "seed").limit(COMMON), "busy")
        largest = again.toArrow()
        if deal + 1 == DEALS or not largest.num_rows:
            return reduce(DataFrame.union, [*out, found]), order
        out.append(found.join(again.select(F.col("seed").alias("_busy")), F.col("seed") == F.col("_busy"), "left_anti"))
        seeds = np.sort(largest.column("seed").to_numpy().view(np.uint64))
        order, busy = _order(order, largest, 1), (order, seeds)


def apart(n: int, m: int, limit: Fraction) -> int:
    """In how many members sets of these sizes may differ if they are similar."""
    return (n + m) * (limit.denominator - limit.numerator) // (limit.denominator + limit.numerator)


def _candidates(limit: Fraction):
    """Pairs of small buckets (seed null) that sizes and places allow, and the sets of larger ones.

    The bucket of the first member that two similar sets share, in the order, has room for all the others behind
    it.  Rows come sorted by seed, size and point; no more than ``LEAF`` sets are held."""

    def run(batches: Batches) -> Iterator[dict]:
        seed, held, large, last = None, [], False, None
        out: dict[str, list] = {c: [] for c in ("seed", "u", "v")}

        def put(*row):
            for column, v in zip(out.values(), row, strict=True):
                column.append(v)

        def close():
            if not large:
                for i, (n, p, at) in enumerate(held):
                    for m, other, there in held[i + 1:]:
                        shared = min(n - at, m - there)
                        if n + m - 2 * shared <= apart(n, m, limit):
                            put(None, p, other)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("seed", "size", "point", "place"))
            for s, n, p, at in zip(*columns, strict=True):
                if s != seed:
                    close()
                    seed, held, large, last = s, [], False, None
                if p == last:
                    continue
                last = p
                if not large and len(held) == LEAF:
                    large = True
                    for b in held:
                        put(s, b[1], None)
                if large:
                    put(s, p, None)
                else:
                    held.append((n, p, at))
            if out["u"]:
                yield out
                out = {c: [] for c in out}
        close()
        if out["u"]:
            yield out

    return run


def _verified(pairs: DataFrame, sets: DataFrame, limit: Fraction) -> DataFrame:
    """The pairs ``(u, v)`` whose whole sets are similar."""

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            out: tuple[list, list] = ([], [])
            left, right = batch.column("left"), batch.column("right")
            u, v = (batch.column(c).to_pylist() for c in "uv")
            for i, pair in enumerate(zip(u, v, strict=True)):
                a, b = (np.frombuffer(side[i].as_buffer(), np.uint64) for side in (left, right))
                if similar(a, b, limit):
                    for column, value in zip(out, pair, strict=True):
                        column.append(value)
            yield dict(zip("uv", out, strict=True))

    one = pairs.join(sets.select(F.col("point").alias("u"), F.col("members").alias("left")), "u")
    both = one.join(sets.select(F.col("point").alias("v"), F.col("members").alias("right")), "v")
    return map_rows(both.select("u", "v", "left", "right"), run, "u long, v long")


def _settled(
    pairs: DataFrame, links: DataFrame, rows: DataFrame, points: DataFrame, words: int, limit: Fraction,
    partners: int,
) -> DataFrame:
    """``links`` and those of the pairs, as far as they tie different components together.

    In each round every set is compared with a few partners; pairs that are decided, or in one component by
    then, go.  ``pairs`` and ``links`` are stored; a number per round comes to the driver.
    """
    if pairs.isEmpty():
        return links
    sets = _sets_of(pairs, rows, points, words)
    while True:
        by_u = Window.partitionBy("v").orderBy("u")
        ranked = pairs.withColumn("_rank", F.row_number().over(by_u))
        now = ranked.filter(F.col("_rank") <= partners).select("u", "v")
        links = stored(links.union(_verified(now, sets, limit)), "linked")
        left = ranked.filter(F.col("_rank") > partners).select("u", "v")
        if left.isEmpty():
            return links
        roots = _roots(links)
        # a link per set says as much
        links = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
        pairs = stored(_apart(left, roots), "left")
        if pairs.isEmpty():
            return links
        partners *= MORE_PARTNERS


def _possible(pairs: DataFrame, sets: DataFrame, limit: Fraction) -> DataFrame:
    """Pairs without those whose parity sketches differ in more bits than similar sets have members
    of one side only; no similar pair goes.  ``sets`` has ``point``, ``size`` and ``parity``."""
    most, whole = limit.denominator - limit.numerator, limit.denominator + limit.numerator

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, PARITY // 64)
                for c in ("left", "right")
            )
            differ = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
            kept = differ * whole <= np.asarray(batch.column("both")) * most
            yield {c: np.asarray(batch.column(c))[kept] for c in "uv"}

    left = sets.select(F.col("point").alias("u"), F.col("parity").alias("left"), "size")
    right = sets.select(F.col("point").alias("v"), F.col("parity").alias("right"), F.col("size").alias("_size"))
    both = pairs.join(left, "u").join(right, "v").withColumn("both", F.col("size") + F.col("_size"))
    return map_rows(both.select("u", "v", "left", "right", "both"), run, "u long, v long").distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs in different components."""
    own = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = pairs.join(own, F.col("u") == F.col("_node"), "left").select(
        "u", "v", F.coalesce("_root", "u").alias("_of_u")
    ).join(own, F.col("v") == F.col("_node"), "left")
    return joined.filter(F.col("_of_u") != F.coalesce("_root", "v")).select("u", "v")


def _sets_of(pairs: DataFrame, rows: DataFrame, points: DataFrame, words: int) -> DataFrame:
    """The whole sets of the points in pairs, stored."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("point")).distinct()
    chosen = points.join(ends, "point", "left_semi").select(F.col("first_id").alias("_id")).distinct()
    return stored(_sets(rows, stored(chosen, "chosen"), words), "sets")


def _sets(rows: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """``(point, members)`` of the chosen IDs' texts; copies seen by a task come once.

    Catalyst sends out the chosen IDs only if their stored size is small.
    """

    def run(batches: Batches) -> Iterator[dict]:
        seen: set[int] = set()
        for batch in batches:
            made = [(point_of(m), m) for m in (shingle_set(t, words) for t in strings(batch.column("text")))]
            new = {p: m for p, m in made if p not in seen}
            if len(seen) >= _SEEN:
                seen.clear()
            seen.update(new)
            yield {"point": list(new), "members": [m.tobytes() for m in new.values()]}

    texts = rows.join(chosen, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    found = map_rows(texts, run, "point long, members binary")
    # a point may have come from several tasks; all its sets are equal
    return found.dropDuplicates(["point"])


def with_point(docs: DataFrame, words: int = 5, text_column: str = "text", point: str = "_point") -> DataFrame:
    """The same rows with the name of their shingle set."""
    kind = docs.schema.simpleString().removeprefix("struct<").removesuffix(">")
    columns = docs.columns

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            texts = strings(batch.column(text_column))
            yield {
                **{c: batch.column(c) for c in columns},
                point: [point_of(shingle_set(t, words)) for t in texts],
            }

    return map_rows(docs, run, f"{kind}, {point}:bigint")


def near_duplicates(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, point, component_id, stays)`` per row; the smallest ID of a component names it.

    Texts link if the Jaccard similarity of their shingle sets is ``similarity`` or more; components
    are those of all links.  ``point`` names the row's set.  Null texts count as empty and empty ones are equal.
    Repeated IDs give repeated rows.  A null ID never names a component unless it has no other member.
    ``stays`` is true for the rows of one ID and set of each component: the smallest ID (null last), then the
    smallest ``point``.
    """
    limit = exact(similarity)
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )

    def named(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            hashes = [shingle_hashes(t, words) for t in strings(batch.column("text"))]
            sets = [np.unique(h) for h in hashes]
            yield {
                "id": batch.column("id"), "point": [point_of(m) for m in sets], "size": [len(m) for m in sets],
                "parity": [parity(m) for m in sets], "fp0": [simhash.fingerprint(h)[0] for h in hashes],
            }

    keyed = stored(map_rows(rows, named, "id long, point long, size long, parity binary, fp0 long"), "points")
    first = [F.min(c).alias(c) for c in ("size", "parity", "fp0")]
    points = stored(keyed.groupBy("point").agg(F.min("id").alias("first_id"), *first), "first")
    links = _grouped(rows, points, words, limit)
    centres = stored(links.groupBy("u").agg(F.count(F.lit(1)).alias("linked")), "centres")
    found, order = _deal(rows, words, limit)
    close = found.filter("seed IS NULL").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    open_pairs = _apart(close.distinct(), _roots(links))
    pairs = stored(_possible(open_pairs, points, limit), "possible")
    links = _settled(pairs, links, rows, points, words, limit, PARTNERS)
    large = found.filter("seed IS NOT NULL").select("seed", F.col("u").alias("point"))
    links = _rest(large, links, centres, rows, points, words, limit, order)
    roots = _roots(links)
    rooted = stored(
        points.select("point", "first_id").join(
            roots.select(F.col("node").alias("point"), "root"), "point", "left"
        ).select("point", "first_id", F.coalesce("root", "point").alias("root")),
        "rooted",
    )
    first = F.min(F.struct(F.col("first_id").isNull().alias("unknown"), "first_id", "point"))
    smallest = rooted.groupBy("root").agg(first.alias("first"))
    classes = stored(
        rooted.join(smallest, "root").select(
            F.col("point").alias("_point"), F.col("first.first_id").alias("component_id"),
            (F.col("first.point") == F.col("point")).alias("_first"),
        ), "classes",
    )
    joined = keyed.select("id", "point").join(classes, F.col("point") == F.col("_point"), "left")
    return joined.select(
        "id", "point", "component_id", (F.col("_first") & F.col("id").eqNullSafe(F.col("component_id"))).alias("stays")
    )


def _roots(links: DataFrame) -> DataFrame:
    """``(node, root)`` of the links' components."""
    found = components(links.select(*[F.col(c).cast("string").alias(c) for c in "uv"]))
    return found.select(*[F.col(c).cast("long").alias(c) for c in ("node", "root")])


def _grouped(rows: DataFrame, points: DataFrame, words: int, limit: Fraction) -> DataFrame:
    """Links ``(u, v)`` of the centres ``u`` of operator 1's groups with those of their sets that are similar.

    A group has one comparison less than sets.  Its centre is nearest to the bits that most of its fingerprints have.
    """
    prints = points.select("point", "size", "fp0", simhash.key([F.col("fp0")]).alias("fingerprint"))
    roots = components(simhash.links(points.select("fp0").distinct(), 1, RADIUS))
    grouped = stored(
        prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
            "point", "size", "fp0", F.coalesce("root", "fingerprint").alias("root")
        ), "groups",
    )
    votes = [F.sum(F.getbit("fp0", F.lit(i)).cast("long")).alias(f"_b{i}") for i in range(64)]
    counted = grouped.groupBy(F.col("root").alias("_root")).agg(F.count(F.lit(1)).alias("_n"), *votes).filter("_n > 1")
    bits = [F.when(F.col(f"_b{i}") * 2 > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)]
    most = counted.select("_root", reduce(lambda a, b: a.bitwiseOR(b), [
        F.coalesce(b, F.lit(0).cast("long")) for b in bits
    ]).alias("_most"))
    met = stored(grouped.join(most, F.col("root") == F.col("_root")).select(
        "root", "point", F.struct(F.bit_count(F.col("fp0").bitwiseXOR(F.col("_most"))), "size", "point").alias("near")
    ), "met")
    centre = met.groupBy(F.col("root").alias("_root")).agg(F.min("near").alias("_near"))
    pairs = met.join(centre, F.col("root") == F.col("_root")).select(
        F.col("_near.point").alias("u"), F.col("point").alias("v")
    ).filter("u != v")
    possible = stored(_possible(pairs, points, limit), "possible")
    if possible.isEmpty():
        return possible
    return stored(_verified(possible, _sets_of(possible, rows, points, words), limit), "linked")


def _order_of_difference(own: np.ndarray, centre: np.ndarray, order: Order) -> np.ndarray:
    """Members of one side only: those of the set, common ones last, before those of the centre."""
    added, removed = (np.setdiff1d(a, b, assume_unique=True) for a, b in ((own, centre), (centre, own)))
    known = _among(added, order.members)
    weight = known.astype(np.int64)
    weight[known] = order.counts[np.searchsorted(order.members, added[known])]
    return np.concatenate([added[np.argsort(weight, kind="stable")], removed])


def difference_prefix(n: int, centre: int, differ: int, limit: Fraction) -> tuple[bool, int]:
    """Whether a set of ``n`` members is similar to its centre, and how much of its difference it is dealt by.

    Sets that differ from a centre in ``X`` and ``Y`` differ in ``|X| + |Y| - 2|X & Y|`` members, which must be
    at most their part of both sizes.  If both were similar to the centre they would be linked.  Otherwise they
    share a member of their differences; and at least ``|X|`` less what similar sets may differ in.  A set that is
    similar to the centre meets only those that are not, and shares over half of its own difference with them.
    """
    part, whole = limit.denominator - limit.numerator, limit.denominator + limit.numerator
    if differ <= apart(n, centre, limit):
        shared = max(1, (whole * differ + part * (centre - n)) // (2 * whole) + 1)
        return True, max(1, differ - shared + 1)
    return False, min(differ, n * part // limit.numerator + 1)


def _differences(pairs: DataFrame, sets: DataFrame, limit: Fraction, order: Order) -> DataFrame:
    """``(centre, seed, point, size, differ, place, linked)``: what sets differ in from their centres."""
    shared = pairs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            names = ("centre", "seed", "point", "size", "differ", "place", "linked", "root")
            out: dict[str, list] = {c: [] for c in names}
            left, right = batch.column("left"), batch.column("right")
            columns = (batch.column(c).to_pylist() for c in ("v", "u", "root"))
            for i, (point, centre, root) in enumerate(zip(*columns, strict=True)):
                c, own = (np.frombuffer(side[i].as_buffer(), np.uint64) for side in (left, right))
                found = _order_of_difference(own, c, shared.value)
                linked, size = difference_prefix(len(own), len(c), len(found), limit)
                seeds = found[:size].view(np.int64)
                out["seed"].append(seeds)
                out["place"].append(np.arange(len(seeds)))
                row = {"centre": centre, "point": point, "size": len(own), "differ": len(found), "linked": linked}
                for column, value in {**row, "root": root}.items():
                    out[column].append(np.full(len(seeds), value))
            if out["seed"]:
                yield {c: np.concatenate(v) for c, v in out.items()}

    one = pairs.join(sets.select(F.col("point").alias("u"), F.col("members").alias("left")), "u")
    both = one.join(sets.select(F.col("point").alias("v"), F.col("members").alias("right")), "v")
    return map_rows(
        both.select("u", "v", "root", "left", "right"), run,
        "centre long, seed long, point long, size long, differ long, place long, linked boolean, root long",
    )


def _differ_alike(limit: Fraction):
    """Pairs of one centre and seed that sizes, differences and places allow, of two components.

    A bucket stands as numbers; blocks of its rows are compared with the rows of sizes that may be similar."""
    part, whole = limit.denominator - limit.numerator, limit.denominator + limit.numerator

    def run(batches: Batches) -> Iterator[dict]:
        for group in sorted_runs(batches, ["centre", "seed"]):
            point, size, differ, place, linked, root = (
                np.asarray(group.column(c))
                for c in ("point", "size", "differ", "place", "linked", "root")
            )
            room = differ - place
            bounds = run_bounds(group, ["centre", "seed"])
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                for at in range(start, end - 1, _BLOCK):
                    stop = min(at + _BLOCK, end)
                    last = start + np.searchsorted(
                        size[start:end], size[stop - 1] * limit.denominator // limit.numerator, "right"
                    )
                    a, b = np.arange(at, stop)[:, None], np.arange(at + 1, last)[None, :]
                    least = differ[a] + differ[b] - 2 * np.minimum(room[a], room[b])
                    near = (b > a) & (least * whole <= (size[a] + size[b]) * part) & (root[a] != root[b])
                    u, v = np.nonzero(near & ~(linked[a] & linked[b]))
                    if len(u):
                        left, right = point[u + at], point[v + at + 1]
                        yield {"u": np.minimum(left, right), "v": np.maximum(left, right)}

    return run


def _rest(
    large: DataFrame, links: DataFrame, centres: DataFrame, rows: DataFrame, points: DataFrame, words: int,
    limit: Fraction, order: Order,
) -> DataFrame:
    """``links`` and those among the sets of larger buckets.

    The centre of a bucket is that of the component with most of its sets.  Every set is compared with its buckets'
    centres, once each, and dealt by its difference from them, so that near copies which just miss the limit
    do not meet for what all copies share.
    """
    known = stored(_roots(links), "known")
    rooted = large.distinct().join(known.withColumnRenamed("node", "point"), "point", "left").select(
        "seed", "point", F.coalesce("root", "point").alias("root")
    )
    counted = stored(rooted.groupBy("seed", "root").agg(F.count(F.lit(1)).alias("n")), "counted")
    most = counted.groupBy("seed").agg(
        F.max_by("root", F.struct("n", "root")).alias("_root"), F.count(F.lit(1)).alias("_roots")
    )
    hubs = centres.join(known, F.col("u") == F.col("node")).groupBy(F.col("root").alias("_of")).agg(
        F.max_by("u", F.struct("linked", "u")).alias("_hub")
    )
    chosen = most.filter("_roots > 1").join(hubs, F.col("_root") == F.col("_of"), "left").select(
        F.col("seed").alias("_seed"), F.coalesce("_hub", "_root").alias("u")
    )
    pairs = stored(
        rooted.join(chosen, F.col("seed") == F.col("_seed")).select("u", F.col("point").alias("v"), "root")
        .filter("u != v").distinct(), "compared",
    )
    if pairs.isEmpty():
        return links
    differences = stored(
        _differences(pairs, _sets_of(pairs, rows, points, words), limit, order), "differences"
    )
    dealt = differences.repartition("centre", "seed").sortWithinPartitions("centre", "seed", "size", "point")
    met = map_rows(dealt, _differ_alike(limit), "u long, v long").distinct()
    tied = differences.filter("linked AND place = 0").select(F.col("centre").alias("u"), F.col("point").alias("v"))
    links = stored(links.union(tied), "linked")
    possible = stored(_possible(_apart(met, _roots(links)), points, limit), "possible")
    return _settled(possible, links, rows, points, words, limit, PARTNERS)
