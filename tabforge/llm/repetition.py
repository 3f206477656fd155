"""Quality rules on repetition within a document (operator 3).

The words of a text form a suffix array, built by prefix doubling: suffixes are ranked by their first 1, 2, 4, ...
words until no two agree, each round sorting only those that still tie. The texts of a batch are sorted together, the
document being part of the first rank, so suffixes of different documents never tie. The ranks of all rounds give the
longest common prefix of neighbours. Intervals of neighbours that share at least ``MIN_REPEAT`` words and can be
extended neither to the left nor to the right are the maximal repeated substrings; the union of their occurrences is
the covered part of a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .stage import text_or_empty

MIN_WORDS = 50
MAX_REPEAT_WINDOW_PERCENT = 50
MIN_REPEAT = 6
MAX_COVERED_PERCENT = 40
MAX_LONGEST = 50

SYMBOLS = ts._bytes_mask(b"#*$%&|<>")
NEWLINE = ts._bytes_mask(b"\n")


def suffix_array(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, length of the common prefix of each with the one before it) of the documents' words."""
    n = len(h)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    new = np.ones(n, dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, length = [rank], 1
    while True:
        tied = np.bincount(rank, minlength=n)[rank] > 1
        act = np.flatnonzero(tied)
        if not len(act):
            break
        nxt = np.full(len(act), -1, dtype=np.int64)
        inside = act + length < n
        follow = act[inside] + length
        nxt[inside] = np.where(doc[follow] == doc[act[inside]], rank[follow], -1)
        own = rank[act]
        order = np.lexsort((nxt, own))
        r, x = own[order], nxt[order]
        at = np.arange(len(act))
        group = np.ones(len(act), dtype=bool)
        group[1:] = r[1:] != r[:-1]
        part = group.copy()
        part[1:] |= x[1:] != x[:-1]
        start = np.maximum.accumulate(np.where(group, at, 0))
        here = np.maximum.accumulate(np.where(part, at, 0))
        rank = rank.copy()
        rank[act[order]] = (r + here - start).astype(np.int32)
        levels.append(rank)
        length *= 2
    sa = np.empty(n, dtype=np.int64)
    sa[rank] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int64)
    pair = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    a, b = sa[pair - 1], sa[pair]
    got = np.zeros(len(pair), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ia, ib = a + got, b + got
        ok = (ia < n) & (ib < n)
        ok[ok] = levels[k][ia[ok]] == levels[k][ib[ok]]
        got[ok] += 1 << k
    lcp[pair] = got
    return sa, lcp


def longest_repeats(sa: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each word the length of the longest run from it on that also stands elsewhere in its document."""
    out = np.zeros(len(sa), dtype=np.int64)
    if len(sa):
        out[sa] = np.maximum(lcp, np.append(lcp[1:], 0))
    return out


def maximal_repeats(sa: np.ndarray, lcp: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first of its suffixes in the order, number of occurrences, length) of the intervals that share ``least`` words
    and whose occurrences don't all follow one word; ``before`` has the word before each suffix, -1 at a beginning.
    Linear in the neighbours that share ``least`` words."""
    n = len(sa)
    hits = np.flatnonzero(lcp >= least)
    stack: list[list[int]] = []  # [length, first in the order, word before all of them or -2 if these differ]
    value, left = lcp.tolist() if len(hits) else [], None
    last = -2
    join = lambda x, y: x if x == y and x != -1 else -2  # noqa: E731  a beginning is never extended
    for i in hits.tolist():
        if i != last + 1:
            yield from _close(stack, last, 0, join)
            left = int(before[sa[i - 1]])
        mine = int(before[sa[i]])
        start, word = i - 1, left
        while stack and stack[-1][0] > value[i]:
            length, start, inner = stack.pop()
            word = inner
            if inner == -2:
                yield start, last - start + 1, length
            if stack and stack[-1][0] >= value[i]:
                stack[-1][2] = join(stack[-1][2], inner)
        if not stack or stack[-1][0] < value[i]:
            stack.append([value[i], start, word])
        stack[-1][2] = join(stack[-1][2], mine)
        left, last = mine, i
    yield from _close(stack, last, 0, join)
    assert n >= len(hits)


def _close(stack, last, value, join):
    while stack:
        length, start, inner = stack.pop()
        if inner == -2:
            yield start, last - start + 1, length
        if stack:
            stack[-1][2] = join(stack[-1][2], inner)


def _union(at: np.ndarray, lengths, n: int) -> np.ndarray:
    """Words covered by the spans [at, at + length)."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: pa.Array, least: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """Counts of each text; see :func:`repetition_rules`."""
    w = ts.Words(texts)
    n, docs = len(w.hash), w.n_texts
    count = lambda x: np.bincount(w.doc[x], minlength=docs).astype(np.int64)
    chars = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
    marks = np.append(0, np.cumsum(SYMBOLS[w.data]))
    word_chars = np.bincount(w.doc, weights=chars[w.ends] - chars[w.starts], minlength=docs).astype(np.int64)
    lines = ts.Words(texts, separators=NEWLINE)
    inked = np.append(0, np.cumsum(~w.gap))
    real = inked[lines.ends] > inked[lines.starts]
    ld, lh = lines.doc[real], lines.hash[real]
    order = np.lexsort((lh, ld))
    again = (ld[order][1:] == ld[order][:-1]) & (lh[order][1:] == lh[order][:-1])
    sa, lcp = suffix_array(w.hash, w.doc)
    longest = longest_repeats(sa, lcp)
    three = np.flatnonzero(longest >= 3)
    held = np.flatnonzero(longest >= least)
    top = np.zeros(docs, dtype=np.int64)
    np.maximum.at(top, w.doc[held], longest[held])
    repeats = np.zeros(docs, dtype=np.int64)
    if len(held):
        _, code = np.unique(w.hash, return_inverse=True)
        before = np.append(-1, code[:-1]) if n else code
        before[w.first[:-1][w.counts > 0]] = -1
        for first, _, _ in maximal_repeats(sa, lcp, before, least):
            repeats[w.doc[sa[first]]] += 1
    return {
        "n_words": w.counts.astype(np.int64), "word_chars": word_chars, "n_symbols": marks[w.text_at[1:]] - marks[w.text_at[:-1]],
        "n_dup_lines": np.bincount(ld[order][1:][again], minlength=docs).astype(np.int64),
        "n_repeat_words": count(_union(three, 3, n)), "covered_words": count(_union(held, longest[held], n)),
        "longest_repeat": top, "n_repeats": repeats,
    }


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "n_repeats"]


def _meter(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.pieces(batches, "text"):
            m = measure(b.column(1), least)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[c], pa.int64()) for c in COLUMNS)], names=["doc_id", *COLUMNS])
    return run


def repetition_rules(spark: SparkSession, docs: DataFrame, least: int = MIN_REPEAT, covered: int = MAX_COVERED_PERCENT,
                     longest: int = MAX_LONGEST) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts and the verdict ``kept``.

    n_words; word_chars (code points in words); n_symbols (of ``#*$%&|<>``); n_dup_lines (lines with a word that
    equal an earlier one); n_repeat_words (words in 3-word windows found twice or more in the text); covered_words
    (words in maximal repeats of ``least`` words or more), longest_repeat and n_repeats (of such repeats, 0 if none);
    base_failed (under 50 words, or over half of them in repeated windows); kept: not base_failed, at most
    ``covered`` percent covered and no repeat of over ``longest`` words.

    Null, empty and wordless texts have zero counts and fail. Null doc_ids and repeated rows are judged like any
    other; an empty table gives an empty result; other columns are ignored. Texts are measured whole, the largest
    alone in its batch.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ddl = "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_WINDOW_PERCENT * F.col("n_words"))
    fine = (100 * F.col("covered_words") <= covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return (rows.mapInArrow(_meter(least), ddl).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine))
