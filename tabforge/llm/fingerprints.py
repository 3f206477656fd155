"""Document fingerprints by threshold-scaled sketches (operator 13).

A fingerprint keeps every distinct shingle hash below a fixed fraction of all hash values. What is kept depends on the
hash alone, so sketches of any two texts, however unequal, hold the same sample of what they share: the part of the
smaller sketch that lies in the other estimates containment, and sketches merge by union.

As text a fingerprint is ``<shingles>:<sum>:<hashes>``: the number of distinct shingles, the sum of all their hashes
modulo 2 ** 64 and the kept ones in ascending order, 16 hex digits each. The sum tells texts apart of which no hash is
kept: equal fingerprints are alike wholly, others as far as their kept hashes are.

Comparing every document with the next one needs the next one's text. Documents are cut into blocks of near-equal bytes
of the order (:func:`prefix.running_sums` over sizes, without the texts), texts go to their blocks in one shuffle, and
the first document of each block is sent to the block before it as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .minhash import SHINGLE, shingle_sets
from .prefix import running_sums
from .stage import BROADCAST_KEYS, Stage, parts_for, text_or_empty

#: One hash in so many is kept.
SCALE = 8
#: Bytes of text in a block, and the most blocks (their first keys go to every task, 16 bytes each).
BLOCK_BYTES, MAX_BLOCKS = 16 << 20, 20_000
FIRST_KEY = -1 << 63


class Sketches:
    """Sketches of the texts of one batch: ``kept[at[i]:at[i + 1]]`` ascend, ``n`` shingles, ``sums`` of their hashes."""

    def __init__(self, texts: pa.Array, scale: int, size: int):
        values, self.n = shingle_sets(texts, size)
        hashes = values.view(ts.U64)
        ends = np.concatenate([[0], np.cumsum(self.n)])
        total = np.concatenate([np.zeros(1, ts.U64), np.cumsum(hashes, dtype=ts.U64)])
        self.sums = total[ends[1:]] - total[ends[:-1]]
        low = hashes <= ts.U64(((1 << 64) - 1) // scale)
        self.kept = hashes[low]
        self.at = np.concatenate([[0], np.cumsum(low)])[ends]

    def texts(self) -> list[str]:
        raw = self.kept.astype(">u8").tobytes()
        return [f"{n}:{s:016x}:{raw[8 * a:8 * b].hex()}" for n, s, a, b in zip(self.n.tolist(), self.sums.tolist(), self.at[:-1].tolist(), self.at[1:].tolist())]

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), np.diff(self.at))

    def part(self, a: int, b: int) -> Sketches:
        out = object.__new__(Sketches)
        out.n, out.sums, out.kept, out.at = self.n[a:b], self.sums[a:b], self.kept[self.at[a]:self.at[b]], self.at[a:b + 1] - self.at[a]
        return out

    def then(self, other: Sketches) -> Sketches:
        out = object.__new__(Sketches)
        out.n, out.sums = np.concatenate([self.n, other.n]), np.concatenate([self.sums, other.sums])
        out.kept, out.at = np.concatenate([self.kept, other.kept]), np.concatenate([self.at, other.at[1:] + self.at[-1]])
        return out


def likeness(a: Sketches, b: Sketches) -> np.ndarray:
    """For each pair the part of the smaller sketch that the other holds; 1 for equal shingle sets, 0 where nothing is kept."""
    row, value = np.concatenate([a.rows(), b.rows()]), np.concatenate([a.kept, b.kept])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    both = np.bincount(row[1:][(row[1:] == row[:-1]) & (value[1:] == value[:-1])], minlength=len(a.n))
    out = both / np.maximum(np.minimum(np.diff(a.at), np.diff(b.at)), 1)
    return np.where((a.n == b.n) & (a.sums == b.sums), 1.0, out)


def retained(fingerprint: Column) -> Column:
    """The kept hashes of a fingerprint, 16 hex digits each."""
    digits = F.split_part(fingerprint, F.lit(":"), F.lit(3))
    return F.filter(F.regexp_extract_all(digits, F.lit("[0-9a-f]{16}"), F.lit(0)), lambda h: h != "")


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the shingles behind array ``a`` of kept hashes that are behind ``b``; null if ``a`` is empty. Arrays
    of several documents may be united first."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def fingerprints(docs: DataFrame, scale: int = SCALE, size: int = SHINGLE) -> DataFrame:
    """docs (doc_id, text) -> doc_id, fingerprint for every row; null texts are empty and have the fingerprint of no shingle."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(Sketches(b.column(1), scale, size).texts())], schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


OUT = pa.schema([("doc_id", pa.int64()), ("copies", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
OUT_DDL = "doc_id long, copies long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(ids, copies, texts, following, own: Sketches, nxt: Sketches, scale: int, size: int) -> pa.RecordBatch:
    edited = []
    for t, f in zip(texts, following):
        k = len(t) // 4
        edited.append(t[:len(t) - k] + f[:k])
    changed = Sketches(pa.array(edited, pa.large_string()), scale, size)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(copies, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(own.texts()), pa.array(changed.texts()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, nxt))], schema=OUT)


def _comparer(scale: int, size: int):
    """Rows (doc_id, copies, halo, text) in order; a row with ``halo`` ends a block and only serves the row before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_sketch = None, None
        for b in ts.pieces(batches, "text"):
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()))
            s = Sketches(b.column(3), scale, size)
            if last:
                rows, s = [last, *rows], last_sketch.then(s)
            last, last_sketch = rows[-1], s.part(len(rows) - 1, len(rows))
            # runs without a halo inside
            start = 0
            for end in [i for i, r in enumerate(rows) if r[2]] + [len(rows) - 1]:
                if end > start:
                    mine = rows[start:end]
                    text = [r[3] for r in rows[start:end + 1]]
                    own = s.part(start, end)
                    yield _compare([r[0] for r in mine], [1] * len(mine), text[:-1], text[1:], own, s.part(start + 1, end + 1), scale, size)
                    for i, r in enumerate(mine):
                        if r[1] > 1:  # copies but the last are followed by a copy
                            o = own.part(i, i + 1)
                            yield _compare([r[0]], [r[1] - 1], [r[3]], [r[3]], o, o, scale, size)
                start = end + 1
    return run


def _block_of(keys: np.ndarray, ties: np.ndarray):
    """A function that gives 2 * block + (1 if the row is its block's first); blocks begin at the given distinct places."""
    @F.pandas_udf("long")
    def block(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        at, first = hi.copy(), np.zeros(len(k), dtype=bool)
        for at_key in np.unique(lo[hi > lo]):
            mine = np.flatnonzero((lo == at_key) & (hi > lo))
            end = int(hi[mine[0]])
            at[mine] = at_key + np.searchsorted(ties[at_key:end], t[mine], "right")
            first[mine] = ties[np.maximum(at[mine] - 1, at_key)] == t[mine]
        return pd.Series(2 * (at - 1) + first)
    return block


def edit_report(spark: SparkSession, docs: DataFrame, scale: int = SCALE, size: int = SHINGLE) -> DataFrame:
    """docs (doc_id, text) -> for every row doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text is the text with its last quarter of code points, rounded down, replaced by
    as many (or all) from the start of the next row; the next of the last row is the first.

    Rows ascend by doc_id, nulls first; rows of one doc_id stand in order of a 64-bit hash of the text, equal rows
    together. A null text is empty: zero shingles, and the fingerprints of two such texts are alike (1). The only row of
    a table is its own next. A text of fewer words than a shingle is one shingle. An empty table gives an empty result;
    other columns are ignored.
    """
    st = Stage(spark, "fingerprints")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_KEY))
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("key", F.xxhash64("text").alias("tie"), "doc_id", "text")
    places = st.put("places", rows.groupBy("key", "tie").agg(F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text").cast("long") + 1).alias("size")))
    placed, sums = running_sums(st, places, ["key", "tie"], "size")
    total = sums.first()["sum"] or 1
    blocks = min(parts_for(spark, total, BLOCK_BYTES), MAX_BLOCKS)
    first = (placed.groupBy(F.expr(f"CAST(CAST(before AS DECIMAL(28, 0)) * {blocks} div {total} AS INT)").alias("b"))
             .agg(F.min(F.struct("key", "tie")).alias("f")).select("b", "f.*").orderBy("b").collect())
    keys, ties = np.array([r["key"] for r in first], np.int64), np.array([r["tie"] for r in first], np.int64)

    many = st.put("many", places.where("copies > 1").select("key", "tie", "copies"))
    n_many = many.count()
    if n_many:  # equal rows become one, combined before the shuffle
        known = F.broadcast(many) if 2 * n_many <= BROADCAST_KEYS else many
        once = rows.join(known, ["key", "tie"], "left_anti").withColumn("copies", F.lit(1).cast("long"))
        copied = rows.join(known, ["key", "tie"]).groupBy("key", "tie").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("copies").alias("copies"))
        rows = once.unionByName(copied)
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    n = max(len(first), 1)
    code = _block_of(keys, ties)(F.col("key"), F.col("tie"))
    sent = (rows.withColumn("code", code).withColumn("b", F.expr("CAST(code div 2 AS INT)"))
            .withColumn("to", F.expr(f"explode(if(code % 2 = 1, array(named_struct('b', b, 'halo', false), named_struct('b', pmod(b - 1, {n}), 'halo', true)), "
                                     "array(named_struct('b', b, 'halo', false))))"))
            .select(F.col("to.b").alias("block"), F.col("to.halo").alias("halo"), "key", "tie", "doc_id", "copies", "text"))
    lined = sent.repartitionById(n, F.col("block")).sortWithinPartitions("block", "halo", "key", "tie").select("doc_id", "copies", "halo", "text")
    out = lined.mapInArrow(_comparer(scale, size), OUT_DDL)
    if n_many:
        out = out.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.drop("_", "copies")
