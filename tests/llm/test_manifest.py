"""Merkle proofs against trees built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tabforge.llm import merkle

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r, add=0):
    doc_id, text, lang, source, n_chars = r
    vals = [doc_id, source, lang, None if n_chars is None else n_chars + add, text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def tree(leaves):
    """(root, proof of each leaf as (side, sibling))."""
    proofs, spans, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        new, new_spans = [], []
        for i in range(0, len(level), 2):
            run = level[i:i + 2]
            for k, x in enumerate(run):
                for j in spans[i + k]:
                    proofs[j].append(("-", "") if len(run) == 1 else ("R", run[1]) if k == 0 else ("L", run[0]))
            new.append(H("".join(run)))
            new_spans.append(sum(spans[i:i + 2], []))
        level, spans = new, new_spans
    return level[0], proofs


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = []
    for g in order:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        made.append((mine, *tree([leaf_of(r) for r in mine])))
    root, tops = tree([m[1] for m in made])
    out = []
    for (mine, sub, proofs), top in zip(made, tops):
        for r, p in zip(mine, proofs):
            p = p + top
            out.append((r[0], leaf_of(r), sub, root, "".join(s for s, _ in p), "".join(h for _, h in p)))
    return sorted(out, key=str)


def spark_rows(spark, rows, parts=3):
    df = spark.createDataFrame(rows, DDL).repartition(parts).withColumns({c: F.lit("x") for c in ("t", "h", "idx", "leaf", "root", "level", "up", "key", "tree")})
    got = merkle.merkle_proofs(spark, df)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.sides, bytes(r.siblings).hex()) for r in got.collect()), key=str), got


ROWS = [(i, f"text {i}", "en", "src0", i) for i in range(1, 301)] + [(i, "é" * i, "fr", None, None) for i in range(400, 405)] + [
    (500, "", "", "s", 0), (501, None, None, None, None), (None, "x", None, "s", 1), (None, None, "en", "s", 1),
    (7, "other", "en", "src0", 3), (8, "text 8", "en", "src0", 8), (600, "lone", "zz", "s", 4), (601, "y" * 300_000, "é", "s", 1)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[:2], ROWS[:3], ROWS[:257], ROWS[300:302] + ROWS[-2:], [ROWS[0], ROWS[-2]], [ROWS[0]] * 5])
def test_proofs_equal_trees_built_by_hand(spark, rows):
    assert spark_rows(spark, rows)[0] == brute(rows)


def test_fold_finds_tampering(spark):
    rows = ROWS[:40]
    _, got = spark_rows(spark, rows)
    back = got.withColumn("again", merkle.fold("leaf")).withColumn("bad", merkle.fold("sha2(leaf, 256)")).collect()
    assert len(back) == 40 and all(r.again == r.root and r.bad != r.root for r in back)


def test_wide_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    assert spark_rows(spark, ROWS)[0] == brute(ROWS)


def test_empty_table(spark):
    assert spark_rows(spark, [], 1)[0] == []


def test_op11_marks_the_tampered(spark):
    from tabforge.llm.queries import merkle_report
    rows = ROWS[:60] + ROWS[300:]
    got = {(r.doc_id, r.leaf): r for r in merkle_report(spark, spark.createDataFrame(rows, DDL)).collect()}
    roots = {(b[0], b[1]): b for b in brute(rows)}
    for r in rows:
        g, b = got[(r[0], leaf_of(r))], roots[(r[0], leaf_of(r))]
        assert g.proof_sha256 == H(b[5]) and g.root == b[3]
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
        assert g.verified is not bad and (g.folded_root == g.root) is not bad
