"""Fingerprints against sets made by hand."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.llm import fingerprints as FP
from tests.llm.util import corpus, frame, prose, words


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def print_of(text):
    return FP.Sketches(pa.array([text]), FP.SCALE, 5).texts()[0]


def kept(fp):
    h = fp.split(":")[2]
    return {h[i:i + 16] for i in range(0, len(h), 16)}


def alike(a, b):
    if a.split(":")[:2] == b.split(":")[:2]:
        return 1.0
    x, y = kept(a), kept(b)
    return len(x & y) / max(min(len(x), len(y)), 1)


def brute(spark, rows):
    ties = {t: h for t, h in spark.createDataFrame([(t,) for t in {t or "" for _, t in rows}] or [("",)], "t string").select("t", F.xxhash64("t")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, ties[r[1] or ""]))
    out = []
    for i, (doc, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 4
        edited = text[:len(text) - k] + nxt[:k]
        a, b, c = print_of(text), print_of(edited), print_of(nxt)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, alike(a, b), alike(a, c)))
    return sorted(out, key=str)


COPIES = [(None, None)] * 3 + [(None, "x")] * 40 + [(5, "same words here again and again")] * 3 + [(6, "É" * 41)] * 2


@pytest.mark.parametrize("block", [300, 50_000, 1 << 30])
@pytest.mark.parametrize("rows", [corpus(), COPIES, COPIES[:1], [(1, "a b c d e f g h"), (2, None)]])
def test_every_row_equals_brute_force(spark, monkeypatch, rows, block):
    monkeypatch.setattr(FP, "BLOCK_BYTES", block)
    got = FP.edit_report(spark, frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(spark, rows)


def test_wide_copies_join(spark, monkeypatch):
    monkeypatch.setattr(FP, "BROADCAST_KEYS", 0)
    assert sorted((tuple(r) for r in FP.edit_report(spark, frame(spark, COPIES)).collect()), key=str) == brute(spark, COPIES)


def test_empty_table(spark):
    assert FP.edit_report(spark, frame(spark, [])).collect() == []


def test_the_fraction_is_kept_of_each_text():
    for text in ("", "one", "a b c d e f", prose(random.Random(1), 9000)):
        n, total, _ = print_of(text).split(":")
        whole = FP.Sketches(pa.array([text]), 1, 5).texts()[0]
        assert int(n) == len(shingles(text)) == len(kept(whole))
        assert total == whole.split(":")[1]
        assert kept(print_of(text)) == {h for h in kept(whole) if int(h, 16) < (1 << 64) // FP.SCALE}


def test_containment_of_unequal_and_merged_texts(spark):
    rng = random.Random(8)
    small, big, other = prose(rng, 3000), prose(rng, 60_000), prose(rng, 3000)
    rows = [(1, small), (2, big + " " + small), (3, other), (4, small + " " + other)]
    fp = FP.fingerprints(frame(spark, rows)).select("doc_id", FP.retained(F.col("fingerprint")).alias("r")).collect()
    r = {x.doc_id: x.r for x in fp}
    df = spark.createDataFrame([(r[1], r[2], r[3], r[4], sorted(set(r[1]) | set(r[3])))], "a array<string>, b array<string>, c array<string>, d array<string>, m array<string>")
    got = df.select(*[FP.containment(F.col(x), F.col(y)).alias(x + y) for x, y in ("ab", "ba", "ac", "ad", "dm")]).first()
    assert got.ab > 0.98 and abs(got.ba - 3000 / 63_000) < 0.02 and got.ac == 0 and abs(got.ad - 1) < 0.02 and got.dm > 0.98
