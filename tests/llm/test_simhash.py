import itertools
import random

import numpy as np
import xxhash

from spanloom.llm import catalog, common, simhash


def brute_fingerprint(text, words=4):
    tokens = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        tokens = tokens.replace(c, " ")
    tokens = [t for t in tokens.split(" ") if t]
    if not tokens:
        return 0
    grams = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """(id, fingerprint) rows to the smallest ID reachable, per row."""
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    ids = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return [(doc, f"{fp:016x}", ids.get(find(i))) for i, (doc, fp) in enumerate(prints)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_query_is_brute_force(spark, sf_dir):
    rows = common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    found = catalog.queries()["op1_simhash"](spark, sf_dir)
    actual = [(r.doc_id, r.fingerprint, r.component_id) for r in found.collect()]
    assert order(actual) == order(brute_components(prints, 4))


def test_edge_rows(make_docs, clashing):
    long = "one two three four five six " * 4000
    rows = [
        (5, None), (4, ""), (9, " \t\n"), (1, "a b c d"), (2, "A  b\tC d"), (2, "A  b\tC d"),
        (7, "x"), (None, "x"), (None, "lonely words here"), (11, long), (12, long + "seven"),
        (13, "É b"), (14, "é b"), (15, "a b"), (-3, ""),
    ]
    found = simhash.near_duplicates(clashing(make_docs(*rows)), words=4, lanes=1, radius=4)
    actual = [(r.id, r.fingerprint, r.component_id) for r in found.collect()]
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    assert order(actual) == order(brute_components(prints, 4))
    assert simhash.near_duplicates(make_docs((1, "a")).limit(0)).count() == 0


def test_tree_finds_what_all_pairs_find():
    rng = random.Random(5)
    for lanes, radius, n in ((1, 4, 700), (1, 4, 40), (2, 9, 500), (1, 0, 300), (1, 20, 400)):
        centers = [[rng.getrandbits(64) for _ in range(lanes)] for _ in range(12)]
        points = set()
        for _ in range(n):
            c = list(rng.choice(centers))
            for _ in range(rng.choice((0, 1, 2, 3, 5, 8, 12))):
                lane = rng.randrange(lanes)
                c[lane] ^= 1 << rng.randrange(64)
            points.add(tuple(c))
        points = np.array(sorted(points), np.uint64)
        links = simhash.vantage_links(points, radius, leaf=8)
        for a, b in links:
            assert a == b or simhash.distances(points[a], points[b]) <= radius
        every = [
            (i, j) for i, j in itertools.combinations(range(len(points)), 2)
            if simhash.distances(points[i], points[j]) <= radius
        ]
        assert simhash.forest(len(points), links) == simhash.forest(len(points), every)


def test_shards_meet_for_all_four_bit_pairs():
    masks = [m % (1 << 64) for m in simhash._masks()]
    rng = random.Random(1)
    for _ in range(2000):
        x = 0
        for _ in range(4):
            x ^= 1 << rng.randrange(64)
        assert any(x & m == 0 for m in masks)


def test_large_run_of_copies_and_near_copies(make_docs):
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base)) for i in range(50)]
    rows += [(100 + i, " ".join([*base[:i], "new", *base[i + 1:]])) for i in range(120)]
    rows += [(500, "something else altogether that nobody repeats anywhere")]
    found = simhash.near_duplicates(make_docs(*rows), words=5, lanes=4, radius=simhash.lanes_radius(0.8, 4))
    by_id = {r.id: r.component_id for r in found.collect()}
    assert by_id[500] == 500
    assert all(c == 0 for i, c in by_id.items() if i != 500)
