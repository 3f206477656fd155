"""Near-duplicate classes and substring removal against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabforge.llm import components, minhash, recompress, textscan
from tabforge.llm.stage import Stage

from .util import corpus, frame, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_classes(rows, percent=75):
    rows = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(rows):
        for j, t in rows[:a]:
            both = len(s & t)
            if both and 100 * both >= percent * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def test_near_duplicates_match_brute_force(spark):
    rows = corpus()
    want = brute_classes(rows)
    got = minhash.near_duplicates(spark, frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    sizes = Counter((i, len(shingles(t))) for i, t in rows)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)


def test_sketches_smaller_than_the_sets_lose_no_link(spark):
    rows = [r for r in corpus(9) if r[0] is not None]
    got = minhash.near_duplicates(spark, frame(spark, rows, extra=False), k=64).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_classes(rows)


def test_near_duplicates_of_nothing(spark):
    got = minhash.near_duplicates(spark, frame(spark, [])).collect()
    assert got == []


def test_bound_on_shared_values():
    assert minhash.least_shared(128) == 66 or 60 <= minhash.least_shared(128) <= 70
    assert minhash.least_shared(32) < minhash.least_shared(64) < minhash.least_shared(128)


def test_components_are_smallest_reachable(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(None, 4), (5, None), (6, 6)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    st = Stage(spark, "test-cc")
    got = components.connected_components(st, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in root} and len(got) == len(root)
    assert components.connected_components(st, spark.createDataFrame([], "a long, b long"), "none").count() == 0


def brute_removal(rows, window):
    count = Counter()
    for _, t in rows:
        w = words(t)
        count.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("window", [35, 8])
def test_removal_matches_brute_force(spark, window):
    rows = corpus(11)
    got = recompress.remove_repeats(spark, frame(spark, rows), window=window).collect()
    assert Counter(tuple(r) for r in got) == brute_removal(rows, window)


def test_removal_digest_and_empty_table(spark):
    rows = [(1, "a b"), (2, None)]
    got = {r.doc_id: r.kept for r in recompress.remove_repeats(spark, frame(spark, rows), digest=True).collect()}
    assert got == {1: hashlib.sha256(b"a b").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
    assert recompress.remove_repeats(spark, frame(spark, [])).collect() == []


def test_symbols_follow_from_the_words_they_depend_on():
    """Wherever the words of a symbol's range stand again, the same symbol stands."""
    rng = np.random.default_rng(1)
    for letters in (2, 3, 50):
        seq = rng.integers(0, letters, 400)
        seq[200:280] = seq[40:120]
        seq[300:340] = seq[300]
        h = textscan.mix(seq.astype(np.uint64))
        doc = np.repeat([0, 1], 200)
        sym, first, end = recompress.parse(h, doc, 4)
        there = {(int(s), int(a)) for s, a in zip(sym, first)}
        for s, a, b in zip(sym.tolist(), first.tolist(), end.tolist()):
            if 40 <= a and b <= 120:
                assert (s, a + 160) in there
            if 200 <= a and b <= 280:
                assert (s, a - 160) in there


def test_word_hashes_agree_with_the_words():
    texts = pa.array(["", None, "a bb  ccc\ta", "x" * 3_000_000 + " a", "é bb", "\n"])
    w = textscan.Words(texts)
    assert w.counts.tolist() == [0, 0, 4, 2, 2, 0]
    found = [bytes(w.data[s:e]).decode() for s, e in zip(w.starts, w.ends)]
    assert found[:4] == ["a", "bb", "ccc", "a"] and found[-2:] == ["é", "bb"]
    assert w.hash[0] == w.hash[3] == w.hash[5] and w.hash[1] == w.hash[7] and len(set(w.hash.tolist())) == 5
