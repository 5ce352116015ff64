import hashlib
from collections import Counter

import numpy as np
import pytest

from spanloom.llm import bloom_sketch as sketch
from spanloom.llm import catalog, common


def brute(rows):
    """(id, text) rows in descending order of ID, each with the next one."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        third = len(text) // 3
        changed = text[:len(text) - third] + after[:third]

        def like(other, text=text):
            a, b = Counter(sketch.pieces(text)), Counter(sketch.pieces(other))
            either = (a | b).total()
            return (a & b).total() / either if either else 1.0

        out[doc] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), like(changed), like(after)
        )
    return out


def check(found, expected):
    assert found.count() == len(expected)
    for r in found.collect():
        n, digest, near_edited, near_next = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert r.near_edited == pytest.approx(near_edited)
        assert r.near_next == pytest.approx(near_next)


def test_query_is_brute_force(spark, sf_dir):
    rows = common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = catalog.queries()["op7_bloom_sketch"](spark, sf_dir).cache()
    check(found, brute([(r.doc_id, r.text) for r in rows]))
    by_text = {}
    texts = {r.doc_id: r.text for r in rows}
    for r in found.collect():
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len({x for s in by_text.values() for x in s}) == len(by_text)


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_edge_rows(make_docs, clashing, ranges):
    long = "\n".join(f"line {i} of a long text. And more words" for i in range(5000))
    rows = [
        (3, None), (4, ""), (8, "a b c"), (15, long), (16, long), (23, "same\n" * 400),
        (42, "é漢🙂" * 30), (-5, "x y z. Other"), (0, "one line"),
    ]
    found = sketch.edited_fingerprints(clashing(make_docs(*rows)), ranges=ranges)
    check(found, brute(rows))


def test_small_tables_and_ties(make_docs):
    assert sketch.edited_fingerprints(make_docs((1, "a")).limit(0)).count() == 0
    one = sketch.edited_fingerprints(make_docs((1, "abcdef"))).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1
    ties = sketch.edited_fingerprints(make_docs((1, "aaa bbb"), (1, "ccc ddd"), (None, "e"), (2, "f"), (2, "f")), ranges=3)
    assert ties.count() == 5


def test_peeling_retries_until_it_succeeds():
    left = [" ".join(f"l{i}" for i in range(n)) for n in (0, 8, 800, 40000)]
    right = [" ".join(f"r{i}" for i in range(n)) for n in (0, 16, 8, 40000)]
    a, b = sketch.Digests(left), sketch.Digests(right)
    rows = np.arange(4)
    assert sketch.differing(a, rows, b, rows, cells=3).tolist() == [0, 3, 101, 10000]
    assert sketch.differing(a, rows, a, rows).tolist() == [0, 0, 0, 0]
