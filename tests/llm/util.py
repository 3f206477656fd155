"""Small hostile tables shared by the operators' tests."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def _name(k):
    return "w" + "".join("bcdfghjklm"[int(c)] for c in str(k))


def prose(rng, n, vocabulary=4000):
    """Invented words of letters."""
    return " ".join(_name(rng.randrange(vocabulary)) for _ in range(n))


def corpus(seed=5):
    """(doc_id, text): copies, near copies, a shared passage, repeated rows, nulls, empty and very long texts."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    rows = [(None, "no id here at all " * 10), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"),
            (7, "a b c d e"), (8, "A b c d e")]
    for i in range(10, 40):
        rows.append((i, prose(rng, rng.randrange(20, 200))))
    base = prose(rng, 200)
    for i in range(40, 70):
        w = base.split()
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    rows += [(i, base + "\n") for i in range(70, 75)]
    rows += [(i, prose(rng, rng.randrange(5, 120)) + " " + passage + " " + prose(rng, rng.randrange(5, 120))) for i in range(80, 100)]
    rows += [(200, "spam and eggs " * 60), (201, prose(rng, 40_000)), (202, "É" * 3000), (203, "line one is here\nline one is here\n\nother\n" * 3)]
    rows += [(10, rows[10][1])] * 2 + [(201, rows[-3][1])]
    return rows


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if extra:  # columns that clash with names the operators use
        df = df.withColumns({c: F.lit("x") for c in ("n", "v", "size", "before", "row", "shard", "chunk", "score", "h", "lang", "source")})
    return df
