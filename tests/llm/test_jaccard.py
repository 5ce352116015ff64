import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanloom.llm import jaccard


def brute_shingles(text, words=5):
    tokens = (text or "").lower().split()
    return {tuple(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))} if tokens else set()


def brute_kept(rows, limit=0.8):
    sets = [brute_shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        union = len(sets[i] | sets[j])
        if not union or 5 * len(sets[i] & sets[j]) >= 4 * union:
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids[find(i)] = min(ids.get(find(i), doc), doc)
    return sorted(ids.values())


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"x{rng.randrange(10**9)}"
    return out


def test_stage_is_brute_force_around_the_limit(spark, sf_dir, make_docs):
    rng = random.Random(8)
    rows, near, below = [], 0, 0
    for i in range(150):
        base = [f"w{rng.randrange(10**9)}" for _ in range(304)]
        # one new word changes five of 300 shingles: similarities from 0.68 to 0.92
        copy = edited(rng, base, rng.randrange(3, 12))
        a, b = brute_shingles(" ".join(base)), brute_shingles(" ".join(copy))
        j = len(a & b) / len(a | b)
        near, below = near + (0.8 <= j <= 0.9), below + (0.7 <= j < 0.8)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    assert near > 30 and below > 30
    rows += [(900, ""), (901, None), (902, "one two"), (903, "One  two"), (904, "one two three")]
    kept = corpus_pipeline.near_dedup_stage(spark, make_docs(*rows), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


def test_large_buckets_are_brute_force(spark, sf_dir, make_docs):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(204)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 9)))) for i in range(60)]
    rows += [(100 + i, " ".join(edited(rng, base[:rng.randrange(80, 204)], 2))) for i in range(40)]
    kept = corpus_pipeline.near_dedup_stage(spark, make_docs(*rows), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


@pytest.mark.parametrize("settings", [{"DEALS": 1}, {"COMMON": 3}, {"LEAF": 2, "PARTNERS": 2}])
def test_settings_change_no_link(make_docs, monkeypatch, settings):
    rng = random.Random(10)
    base = [f"w{i}" for i in range(104)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 5)))) for i in range(40)]
    passage = [f"p{i}" for i in range(30)]
    rows += [(50 + i, " ".join(passage + [f"o{i}-{k}" for k in range(8 + i % 3)])) for i in range(30)]
    for name, value in settings.items():
        monkeypatch.setattr(jaccard, name, value)
    found = jaccard.near_duplicates(make_docs(*rows)).filter("stays").collect()
    assert sorted(r.id for r in found) == brute_kept(rows)


def test_repeated_and_null_ids_keep_one_text_each(spark, sf_dir, make_docs, clashing):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    long = " ".join(f"long{i}" for i in range(30_000))
    rows = [
        (3, a), (7, a), (7, b), (None, a), (None, c), (None, c), (7, b), (9, d), (9, d.upper()), (None, ""), (5, None),
        (11, long), (12, long + " tail"),
    ]
    docs = clashing(make_docs(*rows)).withColumns({c: F.lit("x") for c in ("point", "_point", "u", "stays")})
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, docs, sf_dir).collect()]
    assert sorted(kept, key=str) == sorted([(3, a), (7, b), (None, c), (9, d.upper()), (5, None), (11, long)], key=str)
    empty = corpus_pipeline.near_dedup_stage(spark, docs.limit(0), sf_dir)
    assert empty.count() == 0 and empty.columns == corpus_pipeline.COLUMNS


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    limit = jaccard.exact(0.8)
    for n in range(1, 60):
        pool = np.unique(rng.integers(0, 2**63, n + 20).astype(np.uint64))
        a = np.sort(pool[:n])
        common = np.sort(rng.choice(pool, len(pool) // 2, replace=False))
        b = np.sort(np.concatenate([a[rng.permutation(n)[:n - n // 10]], pool[n:n + n // 10]]))
        if jaccard.similar(a, b, limit):
            assert set(jaccard.prefix(a, common, limit)) & set(jaccard.prefix(b, common, limit))
    assert jaccard.prefix_size(10, limit) == 3 and jaccard.prefix_size(0, limit) == 0


def test_differences_of_similar_sets_meet():
    rng = random.Random(11)
    limit, met = jaccard.exact(0.8), 0
    order = jaccard.Order(np.arange(0, 40, dtype=np.uint64), np.arange(40, dtype=np.int64))

    def moved(members, more, fewer):
        together = set(members.tolist()) | set(rng.sample(range(120), more))
        return np.array(sorted(together - set(rng.sample(range(120), fewer))), np.uint64)

    for _ in range(3000):
        n = rng.randrange(4, 60)
        centre = np.array(sorted(rng.sample(range(120), n)), np.uint64)
        x = moved(centre, rng.randrange(9), rng.randrange(25))
        y = moved(x, rng.randrange(4), rng.randrange(8))
        dealt = []
        for s in (x, y):
            differ = jaccard._order_of_difference(s, centre, order)
            linked, size = jaccard.difference_prefix(len(s), len(centre), len(differ), limit)
            assert linked == jaccard.similar(s, centre, limit)
            dealt.append((linked, set(differ[:size].tolist())))
        if jaccard.similar(x, y, limit) and not np.array_equal(x, y) and not (dealt[0][0] and dealt[1][0]):
            met += 1
            assert dealt[0][1] & dealt[1][1]
    assert met > 100


def test_near_copies_around_the_limit_do_not_meet_in_pairs(make_docs, monkeypatch):
    """Operator 1 groups them first; the rest is dealt by what sets it apart."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(104)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 5)))) for i in range(240)]
    used, met = [], []
    links, possible = jaccard.simhash.links, jaccard._possible
    monkeypatch.setattr(jaccard.simhash, "links", lambda *given: used.append(given[1:]) or links(*given))
    monkeypatch.setattr(jaccard, "_possible", lambda pairs, *given: met.append(pairs.count()) or possible(pairs, *given))
    found = jaccard.near_duplicates(make_docs(*rows)).filter("stays").collect()
    assert sorted(r.id for r in found) == brute_kept(rows)
    assert used == [(1, jaccard.RADIUS)]
    assert sum(met) < 6 * len(rows)
