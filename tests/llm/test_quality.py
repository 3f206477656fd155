"""Repetition rules, toxicity, decontamination and license notices."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tabforge.llm import decontam, licenses, repetition, textscan, toxicity

from .util import corpus, frame, prose, words


def brute_repeats(w, least):
    """Maximal repeats (word tuples) by definition."""
    found = {}
    for size in range(least, len(w)):
        places = {}
        for i in range(len(w) - size + 1):
            places.setdefault(tuple(w[i:i + size]), []).append(i)
        for g, at in places.items():
            if len(at) > 1 and len({w[i - 1] if i else ("begin", i) for i in at}) > 1 and \
                    len({w[i + size] if i + size < len(w) else ("end", i) for i in at}) > 1:
                found[g] = at
        if all(len(at) == 1 for at in places.values()):
            break
    return found


def test_maximal_repeats_match_their_definition():
    rng = random.Random(2)
    for _ in range(60):
        texts = [" ".join(rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randrange(0, 30))) for _ in range(4)]
        least = rng.randrange(1, 5)
        m = repetition.measure(pa.array(texts), least)
        for d, text in enumerate(texts):
            w = text.split()
            want = brute_repeats(w, least)
            covered = {i + k for g, at in want.items() for i in at for k in range(len(g))}
            assert m["n_repeats"][d] == len(want)
            assert m["covered_words"][d] == len(covered)
            assert m["longest_repeat"][d] == max(map(len, want), default=0)


def test_repetition_rules(spark):
    rows = corpus()
    got = repetition.repetition_rules(spark, frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3):
        assert by[i].n_words == 0 and by[i].base_failed and not by[i].kept
    assert by[200].base_failed and by[200].longest_repeat == 177 and by[200].covered_words == 180
    assert by[201].kept and by[201].n_words == 40_000
    assert by[203].n_dup_lines == 7  # three copies of two lines, one of them twice in each
    assert by[202].word_chars == 3000
    assert repetition.repetition_rules(spark, frame(spark, [])).collect() == []
    half = prose(random.Random(1), 100)
    one = repetition.repetition_rules(spark, frame(spark, [(1, half + " " + prose(random.Random(2), 900)), (2, half + " " + half)])).collect()
    assert {r.doc_id: r.kept for r in one} == {1: True, 2: False}


def toxic_corpus(n=600, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = prose(rng, rng.randrange(5, 120), 300).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["grumbus", "Snarfle,", "blorkeling", "blorkelish"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    lab = spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    extra = [(None, "grumbus you"), (9000, None), (9001, ""), (9002, "pure " * 30_000 + "blorkelous"), (0, rows[0][1])]
    got = toxicity.score_documents(spark, frame(spark, rows + extra), lab).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in got)
    truth = {i: y for i, _, y in labels}
    held = [r for r in got if r.held_out]
    assert 150 < len(held) < 260
    right = sum(r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth)
    assert right >= 0.97 * len(held)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[9000].predicted == by[9001].predicted == 0
    first = by[0]
    spans = [rows[0][1].encode()[s.start:s.end].decode() for s in first.spans]
    assert spans and all(x.lower()[:4] in ("grum", "snar", "blor") for x in spans)
    kept = toxicity.keep_clean(frame(spark, rows + extra), toxicity.train(spark, frame(spark, rows), lab))
    assert sorted(kept.columns) == sorted(frame(spark, rows).columns)
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(r.doc_id for r in got if not r.predicted)


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(spark, frame(spark, corpus()[:12]), none).collect()
    assert len(got) == 12 and {r.predicted for r in got} == {0}
    rows, labels = toxic_corpus(40)
    assert toxicity.score_documents(spark, frame(spark, []), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect() == []


def test_marginals_match_enumeration():
    """Forward-backward with powers for plain words against the sum over all taggings."""
    texts = pa.array(["a b T c d T T e", "T", "x y z", "q q q q T"])
    w = textscan.Words(texts)
    toxic_word = w.hash[2]
    model = toxicity.Model(np.array([toxic_word]), np.array([1.7]), -1.1, np.array([[0.4, -0.6], [0.1, 0.8]]), np.zeros(4))
    old, toxicity.feature_hashes = toxicity.feature_hashes, lambda w: iter([w.hash])
    try:
        hit, p = toxicity.tag(model, w)
    finally:
        toxicity.feature_hashes = old
    got = dict(zip(hit.tolist(), p.tolist()))
    for d in range(4):
        at = range(w.first[d], w.first[d + 1])
        total, mass = 0.0, Counter()
        for tags in np.ndindex(*[2] * len(at)):
            s, before = 0.0, 0
            for i, y in zip(at, tags):
                s += model.trans[before, y] + y * (model.bias + (1.7 if w.hash[i] == toxic_word else 0))
                before = y
            total += np.exp(s)
            for i, y in zip(at, tags):
                mass[i] += y * np.exp(s)
        for i in at:
            if w.hash[i] == toxic_word:
                assert abs(got[i] - mass[i] / total) < 1e-9


ITEM = "A train leaves Boston at 9 and travels 120 miles in 2 hours, so Mary asks how fast Mary went in 2 hours."


def test_decontamination_by_templates(spark):
    rng = random.Random(8)
    plain = prose(rng, 30)
    bench = spark.createDataFrame([(1, ITEM, "k"), (2, plain, "k"), (3, None, "k"), (4, "", "k"), (5, "too short", "k"), (2, plain, "k"),
                                   (6, "unit five words only here", "k"), (None, prose(rng, 20), "k")], "item_id long, text string, h string")
    docs = [
        (1, prose(rng, 50) + ", a train leaves Chicago at 7 and travels 300 km in 5 hours, so John Smith asks how fast John Smith went in 5 hours."),
        (2, "A train leaves Chicago at 7 and travels 300 km in 5 hours, so John asks how fast Peter went in 6 hours."),  # John is not Peter, 5 not 6
        (3, prose(rng, 400) + " " + plain + " " + prose(rng, 400)), (4, None), (5, ""), (None, plain), (6, " ".join(plain.split()[:9])),
        (7, prose(rng, 3000)), (8, "see unit five words only here"), (3, "repeated row"),
    ]
    got = decontam.contaminated(spark, frame(spark, docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (3, 2), (8, 6)}
    by = {r.doc_id: r for r in got}
    assert by[1].changed == 6 and by[1].matched >= 6 and by[3].changed == 0 and by[3].matched == by[3].windows
    assert decontam.contaminated(spark, frame(spark, []), bench).collect() == []
    assert decontam.contaminated(spark, frame(spark, docs), bench.limit(0)).collect() == []


def test_decontamination_of_items_that_are_mostly_placeholders_or_short(spark):
    items = ["A car travels 60 miles in 2 hours, then 90 miles in 3 hours. Find 150 miles / 5 hours in miles a second.",
             "Sort the list 5, 3, 9, 1, 7, 2, 8 in ascending order.", "Der Hund von Anna hat 3 Knochen, 4 Decken.", "Define entropy."]
    rng = random.Random(9)
    docs = [(i, prose(rng, 40) + ". " + t + " " + prose(rng, 40)) for i, t in enumerate(items)] + [(9, prose(rng, 200))]
    got = decontam.contaminated(spark, frame(spark, docs), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.matched == r.windows for r in got} == {(i, i): True for i in range(4)}
    t = [r.t for r in frame(spark, [(1, "In a second, 5 m and 3 s: it's a 10 miles run of 2 a day")], extra=False)
         .select(decontam.words_of(licenses.F.col("text")).alias("w")).select(decontam.template_of(licenses.F.col("w")).alias("t")).collect()][0]
    N, U = decontam.NUMBER, decontam.UNIT
    assert t == ["in", "a", "second", N, U, "and", N, U, "it", "s", "a", N, U, "run", "of", N, U, "day"]


def test_decontamination_of_copies_in_other_case_or_spacing(spark):
    item = "The committee that met in Geneva during spring asked whether the treaty signed by Norway could be changed before winter."
    moved = "The committee that met in New York at 5 asked whether the treaty signed by Anna Brown could be changed before winter."
    short = "Rivers carry cold water to Norway"
    rng = random.Random(10)
    copies = [item, item.lower(), item.upper(), item.replace(" Geneva", "\nGeneva").replace(" Norway", "\r\n\tNorway"), item.replace(" ", "  "),
              item.replace(" ", "\u00a0")]
    docs = [(i, prose(rng, 30) + ". " + t + " " + prose(rng, 30)) for i, t in enumerate(copies)]
    docs += [(10, prose(rng, 30) + " " + short + " " + prose(rng, 30)), (11, prose(rng, 30)),
             (12, moved.replace("New York at 5", "Rome at 7").replace("Anna Brown", "Mary\nAnn  Miller"))]
    bench = spark.createDataFrame([(1, item), (2, short), (3, moved)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(spark, frame(spark, docs), bench).collect()}
    assert {k for k in got if k[1] != 3 or k[0] == 12} >= {(i, 1) for i in range(6)} | {(10, 2), (12, 3)}
    assert all(got[i, 1].matched == got[i, 1].windows == 13 for i in range(6)) and not [k for k in got if k[0] == 11]
    assert got[12, 3].changed == 3


def found_by_hand(items, docs):
    """op5 by its definition over tokens (as they stand, template, plain words): dicts of id -> (w, t, p)."""
    N = {decontam.NAME, decontam.NUMBER, decontam.UNIT}
    out = {}
    for item, (w, t, p) in items.items():
        q = [x for part in p for x in part]
        size = min(8, len(q))
        if not q:
            continue
        windows = len(q) - size + 1
        templates = max(len(t) - 7, 1)
        grams = []
        for i in range(templates if len(t) >= 4 else 0):
            for n in (8, 12, 16, 24, 32) if len(t) >= 8 else (len(t),):
                part = t[i:i + n]
                if i + n <= len(t) and sum(x not in N for x in part) >= min(5, -(-min(len(t), 8) * 5 // 8)):
                    low = sum(map(len, p[:i]))
                    grams.append((i, part, w[i:i + n], low, low + max(sum(map(len, p[i:i + n])) - 8, 0)))
                    break
        for doc, (dw, dt, dp) in docs.items():
            dq = [x for part in dp for x in part]
            there = {tuple(dq[k:k + size]) for k in range(len(dq) - size + 1)}
            matched = {j for j in range(windows) if tuple(q[j:j + size]) in there}
            hits = [(i, at, g) for g in grams for i in [g[0]] for at in range(len(dt) - len(g[1]) + 1) if dt[at:at + len(g[1])] == g[1]]
            values = {}
            for i, at, g in hits:
                for k, kind in enumerate(g[1]):
                    if kind in N:
                        values.setdefault(at - i, {}).setdefault((kind, g[2][k].lower()), set()).add(dw[at + k].lower())
            torn = {d for d, v in values.items() if any(len(x) > 1 for x in v.values())}
            changed, canonical = 0, set()
            for i, at, g in hits:
                if at - i in torn and N & set(g[1]):
                    continue
                canonical.add(i)
                matched |= set(range(g[3], g[4] + 1))
                changed = max(changed, sum(max(x) != k[1] or min(x) != k[1] for k, x in values.get(at - i, {}).items()))
            if len(matched) >= 6 or 2 * len(matched) >= windows or 2 * len(canonical) >= templates:
                out[doc, item] = (len(matched), windows, changed)
    return {k: v for k, v in out.items() if v[0]}


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(12)
    filler = ["the", "of", "5", "7", "km", "and", "tree", "red", "Anna", "Bob Ray", "runs", "12", "to"]
    items = {1: ITEM, 2: "Sort the list 5, 3, 9, 1, 7, 2, 8 in ascending order, then give 4 and 6.", 3: "the", 4: "Define the red tree.", 5: prose(rng, 40), 6: ITEM,
             7: "one 1 2 3 4 5 6 7 two three four five six seven 8 9", 8: "", 9: None}
    items |= {20 + i: " ".join(rng.choice(filler) for _ in range(rng.randrange(3, 30))) for i in range(12)}
    docs = {1: prose(rng, 20_000) + " " + items[5] + " " + prose(rng, 300), 2: ITEM.replace("Boston", "Rome").replace("Mary", "Jo"), 3: None, 4: " "}
    docs |= {10 + i: " ".join(rng.choice(filler) for _ in range(rng.randrange(1, 120))) for i in range(20)}
    docs |= {40 + i: prose(rng, 9) + ", " + t.replace("7", "70").replace("Anna", "Eva") for i, t in enumerate(t for t in items.values() if t)}
    def cut(rows):
        df = spark.createDataFrame([(i, t or "") for i, t in rows.items()], "id long, text string").select("id", decontam.words_of(F.col("text")).alias("w"))
        return {r.id: (r.w, r.t, r.p) for r in df.select("id", "w", decontam.template_of(F.col("w")).alias("t"), decontam._plain(F.col("w")).alias("p")).collect()}
    want = found_by_hand(cut(items), cut(docs))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.windows, r.changed) for r in decontam.contaminated(spark, frame(spark, list(docs.items())), bench).collect()}
    assert got == want and len(want) > 40 and any(v[2] for v in want.values())


def test_one_window_of_a_longer_item_is_not_enough(spark):
    item = "At 9 Ann paid 3 dollars for 2 kg while the old dog slept under one tree by 5 pm"
    docs = [(1, "while the old dog slept under one tree"), (2, "At 8 Eve paid 4 dollars for 6 kg while the old dog slept under one tree by 7 pm")]
    got = decontam.contaminated(spark, frame(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(2, 1)]


def test_decontamination_is_native(spark):
    df = decontam.contaminated(spark, frame(spark, corpus()), spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_notices(spark):
    grant = licenses.TEMPLATES["MIT-grant"]
    wrapped = grant.replace(" to deal", "\nto deal").replace(" copies of the Software, and", "\ncopies of the Software, and")
    docs = [
        (1, "words words\nLicensed under CC BY-NC 4.0.\nmore"), (2, "Licensed under CC BY-NC 3.0."), (3, None), (4, ""),
        (5, "intro\n\n" + wrapped + "\n\nend"), (6, "Copyright (c) 2019 Acme Corp. All rights reserved."),
        (7, "we are licensed to sell cars under the sun"), (None, "Released under the MIT License."),
        (8, prose(random.Random(1), 20_000) + "\nReleased under the MIT License.\n" + prose(random.Random(2), 10)),
        (1, "words words\nLicensed under CC BY-NC 4.0.\nmore"),
    ]
    got = licenses.license_notices(spark, frame(spark, docs)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert {(1, "CC-BY-NC-4.0"), (5, "MIT-grant"), (6, "Copyright"), (8, "MIT"), (None, "MIT")} <= found
    assert not {i for i, _ in found} & {2, 3, 4, 7}
    first = next(r for r in got if r.doc_id == 8 and r.license == "MIT")
    assert docs[8][1][first.start:].startswith("Released")
    assert licenses.license_notices(spark, frame(spark, [])).collect() == []
    assert len(words("a b")) == 2


def test_short_notices_inside_longer_lines(spark):
    rng = random.Random(3)
    texts = {"MIT": "This file is part of libfoo. Released under the MIT License. See AUTHORS for the people who wrote it.",
             "CC-BY-4.0": prose(rng, 8) + " Licensed under CC BY 4.0. " + prose(rng, 8),
             "All-rights-reserved": "The Daily News, 12 High Street, Springfield. All rights reserved.",
             "Apache-2.0": prose(rng, 400) + " Licensed under the Apache License, Version 2.0. " + prose(rng, 400),
             "Copyright": "Copyright (c) 2019 The Board of Trustees of Leland Stanford Junior University. All rights reserved."}
    got = licenses.license_notices(spark, frame(spark, list(enumerate(texts.values())))).collect()
    assert {(r.doc_id, r.license, r.notices, r.changed) for r in got} == {(i, n, 1, 0) for i, n in enumerate(texts)}


def test_every_notice_of_a_block_is_reported(spark):
    texts = [("Copyright (c) 2019 Acme Corp. All rights reserved. Licensed under the Apache License, Version 2.0.", {"Copyright", "Apache-2.0"}),
             ("Released under the MIT License. This work is licensed under the GNU Lesser General Public License, version 3.", {"MIT", "LGPL-3.0"}),
             ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
             ("Licensed under CC BY-SA 4.0. Licensed under CC BY 4.0. Released under the MIT License. All rights reserved.",
              {"CC-BY-SA-4.0", "CC-BY-4.0", "MIT", "All-rights-reserved"})]
    got = licenses.license_notices(spark, frame(spark, [(i, t) for i, (t, _) in enumerate(texts)])).collect()
    assert {(r.doc_id, r.license) for r in got} == {(i, n) for i, (_, names) in enumerate(texts) for n in names}


def test_compression_decides_and_ranks(monkeypatch):
    """Without the sizes nothing is found; where the wording allows two templates, that which saves more stands."""
    texts = ["This work is licensed under the GNU Lesser General Public License, version 3.", "Licensed under CC BY 4.0. All rights reserved.",
             "x Copyright (c) 2019 Acme Corp. All rights reserved. y"]
    found = [licenses.Matcher(licenses.TEMPLATES).confirm(t) for t in texts]
    assert [[n for n, *_ in f] for f in found] == [["LGPL-3.0"], ["CC-BY-4.0", "All-rights-reserved"], ["Copyright"]]
    assert all(0 < part < 1 for f in found for _, part, *_ in f)
    monkeypatch.setattr(licenses.Matcher, "saved", lambda self, span, i: (0, 0.0))
    assert [licenses.Matcher(licenses.TEMPLATES).confirm(t) for t in texts] == [[], [], []]
    monkeypatch.setattr(licenses.Matcher, "saved", lambda self, span, i: (1, 0.5))
    assert [[n for n, *_ in licenses.Matcher(licenses.TEMPLATES).confirm(t)] for t in texts] != [[n for n, *_ in f] for f in found]


def test_matcher_equals_brute_force():
    """All spans of all templates, without cues and first words to guide the search."""
    rng = random.Random(14)
    m = licenses.Matcher(licenses.TEMPLATES)
    names = list(licenses.TEMPLATES)
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            w = licenses.TEMPLATES[rng.choice(names)].replace("<year>", "2020").replace("<holder>", "Some Body").split()
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(["other", "", "License", "the"])
            parts += [" ".join(w), prose(rng, rng.randrange(0, 12))]
        block = " ".join(parts)
        at = [x.span() for x in licenses.SEARCH_WORDS.finditer(block)]
        low = licenses.words_of(block)
        spans = []
        for i in range(len(names)):
            for s in range(len(at)):
                end = min(len(at), s + m.reach[i])
                gain, part = m.saved(block[at[s][0]:at[end - 1][1]], i)
                changed, a, b = licenses.differences(m.words[i], low[s:end])
                literal = [w for w in m.words[i] if not w.startswith("<")]
                if part >= licenses.MIN_SAVED and changed <= m.allowed[i] and b > a and low[s] in literal[:m.allowed[i] + 1]:
                    spans.append((-gain, i, s, s + a, s + b))
        want, taken = [], []
        for _, i, _, a, b in sorted(spans):
            if not any(x < b and a < y for x, y in taken):
                taken.append((a, b))
                want.append((names[i], at[a][0]))
        assert [(n, off) for n, _, _, off, _ in m.confirm(block)] == want


def test_decontamination_of_endless_names_and_numbers(spark):
    """A regular expression that takes a stack frame for each word of a name ends in a StackOverflowError."""
    names, numbers = "see" + " Retionly" * 20_000, "1" + ".5" * 20_000
    df = spark.createDataFrame([(1, names), (2, numbers), (3, "Then, Ann Bell Cole paid 1,200.50 to Dan")], "id long, text string")
    got = {r.id: r.w for r in df.select("id", decontam.words_of(F.col("text")).alias("w")).collect()}
    assert got == {1: ["see", names[3:]], 2: [numbers], 3: ["Then", " Ann Bell Cole", "paid", "1,200.50", "to", " Dan"]}
    docs = [(1, f"{names} {ITEM}"), (2, f"{numbers} {ITEM}"), (3, names), (4, numbers)]
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert {r.doc_id for r in decontam.contaminated(spark, frame(spark, docs), bench).collect()} == {1, 2}
