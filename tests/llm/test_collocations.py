"""Collocations against counting by hand."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabforge.llm import collocations as C
from tests.llm.util import prose

LOWER = str.maketrans(C.UPPER, C.LOWER)


def brute(rows, longest=3, least=10, swallow=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= swallow * cand[lang, w[i:i + k]]:
                    gone.add((lang, w[i:i + k]))
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            score, _, l, r = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    rows = []
    for lang, found in out.items():
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]):
            rows.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(rows)


def table(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    return df.withColumns({c: F.lit("x") for c in ("doc", "pos", "id", "word", "a", "left", "right", "n", "doc_id")})


def hostile():
    rng = random.Random(3)
    rows = [(None, "en"), ("", "en"), (" \t .,", None), ("one. two, three", None)]
    for i in range(150):
        rows.append((" ".join(rng.choice([prose(rng, 1, 12), "Tab\tand", "x.", "é!", "A,b"]) for _ in range(rng.randrange(3, 80))), rng.choice(["en", "fr", None, "und", ""])))
    rows += [("The quick brown fox jumps; the QUICK brown dog: spam spam spam spam", "en")] * 40
    rows += [("a b c\x00d  e É é A\x0bB", "de")] * 12 + [(prose(rng, 30_000, 40), "es")]
    return rows


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_counts_by_hand(spark, longest):
    rows = hostile()
    want = brute(rows, longest)
    assert len(want) > 200
    assert sorted(tuple(r) for r in C.top_collocations(spark, table(spark, rows), longest).collect()) == want


def test_limits_and_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_WORDS", 0)
    monkeypatch.setattr(C, "BROADCAST_PHRASES", 0)
    rows = hostile()
    got = C.top_collocations(spark, table(spark, rows), 3, 11, 80, 7)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 11, 80, 7)


def test_empty_tables(spark):
    assert C.top_collocations(spark, table(spark, [], 1)).collect() == []
    assert C.top_collocations(spark, table(spark, [(None, None), ("", "en")], 1)).collect() == []


def test_products_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_000, 4_000_000_000_000, 5_000_000_000_001
    df = spark.createDataFrame([("en", ["x", "y"], a, [l], [r], None, 10 ** 15)], "lang string, words array<string>, a long, heads array<long>, tails array<long>, longer long, n long")
    orig, C.mine = C.mine, lambda *x: df
    try:
        assert C.top_collocations(spark, df).first()["score"] == 1000000 * a * a // (l * r)
    finally:
        C.mine = orig


def test_merge_join_without_shuffle(spark):
    """Both sides of the join lie together by document: no exchange below it."""
    from tabforge.llm.stage import Stage
    rel = C.Relations(Stage(spark, "plan"), 4)
    r = rel.put("r1", spark.range(100).selectExpr("id % 10 AS doc", "id AS pos", "id").repartition(4, "doc"))
    with C._planned(spark):
        j = r.withColumnRenamed("id", "left").hint("merge").join(r.select("doc", (F.col("pos") - 1).alias("pos"), F.col("id").alias("right")), ["doc", "pos"])
        plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Sort [") <= 1
