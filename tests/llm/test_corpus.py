"""Shared passages, quality, licences, decontamination, token counts and the pipeline."""

import itertools
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from spanloom.llm import catalog, chains, common, decontaminate, licenses, quality, token_counts


def prose(seed, n):
    rng = random.Random(seed)
    return [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(500)}" for _ in range(n)]


def test_shared_passages(make_docs, clashing):
    passage, other = prose(1, 60), prose(2, 120)
    changed = [*other[:40], "edited", "words", *other[41:80], *other[82:]]
    rows = [
        (1, " ".join(prose(10, 90) + passage + prose(11, 50))), (2, " ".join(prose(12, 33) + passage)),
        (3, " ".join(passage + prose(13, 200))), (4, " ".join(prose(14, 300))),
        (5, " ".join(other)), (6, "start " + " ".join(changed)), (7, " ".join(passage[:30] + prose(15, 90))),
        (8, None), (9, ""), (10, "short text"), (None, " ".join(passage)),
        (20, "same words again " * 400), (21, "same words again " * 400),
    ]
    found = chains.shared_passages(clashing(make_docs(*rows))).collect()
    spans = {(r.doc_id, r.anchor_id): r for r in found if r.doc_id < 20}
    assert set(spans) == {(2, 1), (3, 1), (6, 5)}
    assert (spans[2, 1].start, spans[2, 1].end, spans[2, 1].anchor_start) == (33, 93, 90)
    assert (spans[3, 1].start, spans[3, 1].end, spans[3, 1].identity) == (0, 60, 1.0)
    assert spans[6, 5].start == 1 and spans[6, 5].end == 1 + len(changed) and spans[6, 5].identity > 0.9
    assert chains.shared_passages(make_docs(*rows).limit(0)).count() == 0


def brute_passages(texts, words=50, identity=0.8):
    """All pairs of texts with a passage, words replaced only: every diagonal of every pair."""
    found = set()
    for b in texts:
        for a in texts:
            if a >= b:
                continue
            x, y = texts[a], texts[b]
            for shift in range(-len(y) + words, len(x) - words + 1):
                overlap = [p == q for p, q in zip(x[max(shift, 0):], y[max(-shift, 0):], strict=False)]
                total = np.concatenate([[0], np.cumsum(overlap)])
                if len(overlap) >= words and (total[words:] - total[:-words]).max() >= identity * words:
                    found.add((b, a))
    return found


@pytest.mark.parametrize("every,length,least", [
    (0, 50, 1.0), (20, 60, 0.95), (12, 60, 0.9), (10, 60, 0.9), (8, 60, 0.8), (10, 100, 0.9), (8, 100, 0.9), (6, 100, 0.75),
])
def test_recall_of_edited_passages(make_docs, every, length, least):
    texts = {}
    for n in range(30):
        passage = prose(1000 * every + n, length)
        copy = [f"x{i}" if every and i % every == every - 1 else w for i, w in enumerate(passage)]
        texts[2 * n] = prose(f"a{n}", 20) + passage + prose(f"b{n}", 20)
        texts[2 * n + 1] = prose(f"c{n}", 30) + copy + prose(f"d{n}", 10)
    wanted = {(2 * n + 1, 2 * n) for n in range(30)}
    some = {i: t for i, t in texts.items() if i < 8}
    assert brute_passages(some) == {p for p in wanted if p[0] < 8}
    rows = chains.shared_passages(make_docs(*[(i, " ".join(t)) for i, t in texts.items()])).collect()
    found = {(r.doc_id, r.anchor_id) for r in rows}
    assert found <= wanted and len(found) >= least * len(wanted)


def test_passages_whose_parts_stand_earlier(make_docs):
    texts = {}
    for n in range(12):
        at, passage = 10 * n, prose(f"p{n}", 60)
        cuts = [0, 30, 60] if n % 2 else [0, 20, 40, 60]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            texts[at + i] = prose(f"{at}{i}", 25) + passage[a:b] + prose(f"e{at}{i}", 25)
        for i in (5, 6, 7):
            texts[at + i] = prose(f"{at}{i}", 15) + passage + prose(f"e{at}{i}", 15)
    rows = chains.shared_passages(make_docs(*[(i, " ".join(t)) for i, t in texts.items()])).collect()
    found = {(r.doc_id, r.anchor_id) for r in rows}
    assert found <= brute_passages(texts)
    for n in range(12):
        assert {(10 * n + 6, 10 * n + 5), (10 * n + 7, 10 * n + 5)} <= found


def brute_chain(x, y, k, cost):
    score = []
    for i in range(len(x)):
        before = [
            score[j] - cost * (x[i] - x[j] - k + y[i] - y[j] - k)
            for j in range(i) if x[j] < x[i] and y[j] < y[i]
        ]
        score.append(k + max([0.0, *before]))
    return max(score)


@pytest.mark.parametrize("copies", [4, 30])
def test_passages_whose_seeds_are_all_common(make_docs, copies):
    """Each part of a passage stands in several earlier documents, and its later copy is edited."""
    rng = random.Random(5)
    new = itertools.count()

    def words(n):
        return [f"w{next(new)}" for _ in range(n)]

    texts = {}
    for n in range(6):
        passage = [f"p{n}x{rng.randrange(10**6)}" for _ in range(72)]
        for at in range(0, 60, 6):
            for _ in range(copies):
                texts[len(texts)] = words(15) + passage[at:at + 18] + words(15)
        edited = [w if i % 12 != 11 else next(iter(words(1))) for i, w in enumerate(passage)]
        texts[10_000 + 2 * n] = words(30) + passage + words(30)
        texts[10_001 + 2 * n] = words(30) + edited + words(30)
    rows = chains.shared_passages(make_docs(*[(i, " ".join(t)) for i, t in texts.items()])).collect()
    found = {(r.doc_id, r.anchor_id) for r in rows if r.end - r.start >= 60}
    assert {(10_001 + 2 * n, 10_000 + 2 * n) for n in range(6)} <= found


def test_chains_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        points = sorted({(rng.randrange(120), rng.randrange(120)) for _ in range(rng.randrange(1, 60))})
        x, y = (np.array(v) for v in zip(*points, strict=True))
        found = chains.chain(x, y, 4, 0.2)
        assert sorted(i for c in found for i in c) == list(range(len(x)))
        best = found[0]
        total = 4 * len(best) - sum(
            0.2 * (x[b] - x[a] + y[b] - y[a] - 8) for a, b in zip(best, best[1:], strict=False)
        )
        assert total == pytest.approx(brute_chain(x, y, 4, 0.2))


def test_any_shared_run_shares_a_seed():
    h = np.array([zlib.crc32(w.encode()) for w in prose(3, 400)], np.uint64)
    for at in range(0, 350, 7):
        own = set(chains.seeds(h)[0].tolist())
        part = np.concatenate([np.arange(5, dtype=np.uint64), h[at:at + 23], np.arange(9, 15, dtype=np.uint64)])
        assert own & set(chains.seeds(part)[0].tolist())


def test_quality_on_held_out_labels(spark, sf_dir):
    found = catalog.queries()["op3_quality"](spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in common.table(spark, sf_dir, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.9


def test_quality_edge_rows(spark, make_docs, clashing):
    docs = clashing(make_docs((1, None), (2, ""), (3, "fine words here."), (3, "fine words here."), (None, "!!! ###")))
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 1), (9, None)], "doc_id long, quality int")
    for usable in (labels, labels.limit(0)):
        model = quality.fit(docs, usable, held_out_bucket=None)
        assert quality.score(docs, model).count() == 5
        assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score(docs.limit(0), model).count() == 0


def test_licenses(make_docs, clashing):
    mit = licenses.KNOWN["MIT"][2]
    rows = [
        (1, "Copyright (c) 2001 Somebody\n" + mit.upper().replace(",", " ,")), (2, "text\nreleased under the MIT licence\nmore"),
        (3, None), (4, ""), (5, "Copyright 2020 X"), (6, "the MIT License is fine"), (None, "Licensed under CC-BY-NC 4.0"),
        (2, "text\nreleased under the MIT licence\nmore"),
    ]
    found = licenses.license_matches(clashing(make_docs(*rows)))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(
        [(1, None, "MIT"), (2, 1, "MIT"), (2, 1, "MIT"), (None, None, "CC-BY-NC-4.0")], key=str
    )
    assert licenses.license_matches(make_docs((1, "a")).limit(0)).count() == 0


def brute_coverage(item, doc, least):
    """Greedy tiling by looking at every pair of places."""
    a, b = decontaminate.tokens(item), decontaminate.tokens(doc)
    used_a, used_b = [False] * len(a), [False] * len(b)
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]
                       and not used_a[i + n] and not used_b[j + n]):
                    n += 1
                if n >= least and (n > best[0]):
                    best = (n, i, j)
        if not best[0]:
            return sum(used_a) / len(a) if a else 0.0
        n, i, j = best
        used_a[i:i + n] = used_b[j:j + n] = [True] * n


def test_tiling_is_brute_force(spark, make_docs, clashing):
    items = [" ".join(prose(i, 24)) for i in range(6)] + ["one two three", "", None]
    def parts(i):
        return items[i].split()

    rows = [
        (1, " ".join(prose(50, 20) + parts(0) + prose(51, 9))),
        (2, " ".join(parts(1)[12:] + ["x"] + parts(1)[:12])),
        (3, " ".join(parts(2)[:9] + prose(52, 30))),
        (4, " ".join(w.upper() + "," for w in parts(3)[8:16] + ["y"] + parts(3)[16:] + ["z"] + parts(3)[:8])),
        (5, None), (6, ""), (7, " ".join(prose(53, 500))), (8, "one two three"),
        (9, " ".join(parts(4) * 30)), (9, " ".join(parts(4) * 30)), (None, items[5]),
    ]
    docs = clashing(make_docs(*rows))
    bench = spark.createDataFrame([*enumerate(items), (0, items[0])], "item_id long, text string")
    expected = sorted(
        ((d, i, round(c, 6)) for d, t in rows for i, x in enumerate(items)
         if x and t and (c := brute_coverage(x, t, 5)) >= 0.6), key=str,
    )
    for size in (1 << 22, 200):
        found = decontaminate.contaminated(docs, bench, block_bytes=size)
        assert sorted(((r.doc_id, r.item_id, round(r.coverage, 6)) for r in found.collect()), key=str) == expected
    kept = decontaminate.drop_contaminated(docs, bench, block_bytes=200)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 8]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def brute_tokens(unigram, word):
    best = [(0.0, 0)] + [(-np.inf, 0)] * len(word)
    for end in range(1, len(word) + 1):
        options = [(best[end - 1][0] + unigram.unknown, -best[end - 1][1] - len(word[end - 1].encode()))]
        options += [
            (best[s][0] + unigram.scores[word[s:end]], -best[s][1] - 1)
            for s in range(end) if word[s:end] in unigram.scores
        ]
        score, count = max(options)
        best[end] = (score, -count)
    return best[-1][1]


def test_token_counts_are_brute_force(spark, sf_dir, make_docs, clashing):
    unigram = token_counts.Unigram(catalog.vocabulary_path())
    odd = [(1, None), (2, ""), (3, "🙂漢字 \x00 é"), (3, "x" * 500), (None, "two words"), (5, "  \n")]
    docs = clashing(make_docs(*odd))
    found = token_counts.token_counts(docs, catalog.vocabulary_path(), nodes=20)
    expected = [
        (i, len(w), sum(brute_tokens(unigram, x) for x in w))
        for i, t in odd for w in [token_counts.pre_tokens(t or "")]
    ]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)
    texts = common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()[:40]
    counts = {r.doc_id: r.n_tokens for r in catalog.queries()["op9_token_counts"](spark, sf_dir).collect()}
    for r in texts:
        assert counts[r.doc_id] == sum(brute_tokens(unigram, x) for x in token_counts.pre_tokens(r.text))


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = common.table(spark, sf_dir, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in common.table(spark, sf_dir, "labels").collect()}
    sizes = [len(before)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        if name == "quality":
            kept = {r.doc_id for r in docs.collect()}
            assert np.mean([(i in kept) == bool(q) for i, q in labels.items()]) > 0.95
        if name == "near_dedup":
            texts = [r.text for r in docs.collect()]
            assert len(set(texts)) == len(texts)
        if name != "encoding":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 100
    assert corpus_pipeline.run(spark, sf_dir).count() == sizes[-1]


def test_pipeline_on_empty_and_odd_documents(spark, sf_dir, make_docs):
    for docs in (make_docs((1, "a")).limit(0), make_docs((1, None), (2, ""), (3, "x y z"), (3, "x y z"))):
        for _, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, sf_dir), "odd")
        assert docs.count() <= 3
