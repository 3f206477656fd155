"""Substring deduplication by recompression (operator 6).

Each round names runs of one symbol (symbol, length) and pairs of neighbours whose first symbol falls into the left
half of the alphabet and whose second falls into the right half. Names are hashes of what they stand for, so equal
substrings get equal names in all documents without a common table, save near their ends, where the neighbours differ.
Every symbol keeps the words that its shape depends on: wherever these words stand again, the same symbol does.

1. Texts are packed into chunks and parsed; a first Spark round finds the symbols that occur more than once.
2. A window of words that stands elsewhere has only such symbols among those that depend on its words alone. Windows
   that pass are named by a hash of their words; a second Spark round finds the windows that occur more than once.
3. Words that a repeated window covers are removed.

Both rounds send names, packed by chunk and bucket, to buckets of bounded size and the repeated ones back to their
chunks. A chunk sends a name at most twice, so a passage that many documents hold adds two values for each chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .stage import Stage, parts_for, text_or_empty

WINDOW = 35
ROUNDS = 4
BUCKET_VALUES = 1 << 20
U64 = np.uint64
_RUN, _LEN, _LEFT, _RIGHT = (U64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))

CHUNK_DDL = "chunk long, doc_ids array<long>, lens array<long>, words long, blob binary"


def parse(h: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first, end): symbols after ``rounds`` rounds and the range of words that each depends on.

    A symbol at an end of its document depends on that end, which is written as a word before or after it.
    """
    n = len(h)
    at = np.arange(n, dtype=np.int64)
    sym, d, first, end = h, doc, at, at + 1

    def neighbours():
        same = d[1:] == d[:-1]
        left, right = np.empty_like(first), np.empty_like(end)
        left[1:] = np.where(same, first[:-1], first[1:] - 1)
        right[:-1] = np.where(same, end[1:], end[:-1] + 1)
        if len(d):
            left[0], right[-1] = first[0] - 1, end[-1] + 1
        return same, np.minimum(first, left), np.maximum(end, right)

    for r in range(rounds):
        if not len(sym):
            break
        # runs: a symbol's run ends where the neighbours differ
        same, left, right = neighbours()
        joined = same & (sym[1:] == sym[:-1])
        head = np.append(True, ~joined)
        start = np.flatnonzero(head)
        size = np.diff(np.append(start, len(sym)))
        last = start + size - 1
        name = sym[start]
        long = size > 1
        name[long] = ts.mix(name[long] * _RUN + size[long].astype(U64) * _LEN + U64(r))
        sym, d, first, end = name, d[start], left[start], right[last]
        # pairs: left half before right half
        same, left, right = neighbours()
        half = (ts.mix(sym + U64(r + 101)) >> U64(63)).astype(bool)
        pair = np.flatnonzero(same & ~half[:-1] & half[1:])
        keep = np.ones(len(sym), dtype=bool)
        keep[pair + 1] = False
        name = sym.copy()
        name[pair] = ts.mix(sym[pair] * _LEFT + sym[pair + 1] * _RIGHT + U64(r))
        alone = keep.copy()
        alone[pair] = False
        low, high = first.copy(), end.copy()
        low[alone & half] = left[alone & half]
        high[alone & ~half] = right[alone & ~half]
        low[pair] = np.minimum(first[pair], first[pair + 1])
        high[pair] = np.maximum(end[pair], end[pair + 1])
        sym, d, first, end = name[keep], d[keep], low[keep], high[keep]
    return sym, first, end


def candidates(words: ts.Words, window: int, shared: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """First words of the windows all of whose own symbols are in ``shared`` (ascending)."""
    n = len(words.hash)
    sym, first, end = parse(words.hash, words.doc, rounds)
    own = end - first <= window
    sym, first, end = sym[own], first[own], end[own]
    where = np.minimum(np.searchsorted(shared, sym), max(len(shared) - 1, 0))
    single = shared[where] != sym if len(shared) else np.ones(len(sym), dtype=bool)
    edge = np.zeros(n + 2, dtype=np.int64)  # windows that hold a symbol of one occurrence begin in [end - window, first]
    np.add.at(edge, np.maximum(end[single] - window, 0), 1)
    np.add.at(edge, np.maximum(first[single] + 1, 0), -1)
    free = np.cumsum(edge[:n]) == 0
    starts = np.flatnonzero(words.doc[:n - window + 1] == words.doc[window - 1:]) if n >= window else np.zeros(0, np.int64)
    return starts[free[starts]]


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    number, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
    for b in ts.pieces(batches, "text"):
        w = ts.Words(b.column(1))
        row = [number, b.column(0), np.diff(w.text_at), len(w.hash), press.compress(w.data.tobytes())]
        number += 1
        yield pa.RecordBatch.from_arrays([
            pa.array([row[0]], pa.int64()), pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), row[1]),
            pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), pa.array(row[2], pa.int64())),
            pa.array([row[3]], pa.int64()), pa.array([row[4]], pa.binary())], names=["chunk", "doc_ids", "lens", "words", "blob"])


def _unpack(chunk) -> tuple[pa.Array, ts.Words]:
    """(doc_ids, words) of row 0 of a chunk table."""
    get = lambda c: chunk.column(chunk.schema.get_field_index(c))[0]
    data = zstandard.ZstdDecompressor().decompress(get("blob").as_py())
    lens = np.asarray(get("lens").values, dtype=np.int64)
    at = np.append(0, np.cumsum(lens))
    texts = pa.LargeStringArray.from_buffers(len(lens), pa.py_buffer(at), pa.py_buffer(data))
    return get("doc_ids").values, ts.Words(texts)


def _twice(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Of sorted values, the places to keep so that each stands at most twice; same[i]: value i equals the one before."""
    third = np.zeros(len(order), dtype=bool)
    third[2:] = same[1:] & same[:-1]
    return order[~third]


def _deal(chunk: int, buckets: int, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket that gets values: (bucket, chunk, lo, hi), each value at most twice."""
    order = np.lexsort((hi, lo))
    same = (lo[order][1:] == lo[order][:-1]) & (hi[order][1:] == hi[order][:-1])
    order = _twice(order, same)
    lo, hi = lo[order], hi[order]
    b = ((lo >> U64(32)) % U64(buckets)).astype(np.int64)
    by = np.argsort(b, kind="stable")
    counts = np.bincount(b, minlength=buckets)
    full = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([
        pa.array(full, pa.int64()), pa.array(np.full(len(full), chunk), pa.int64()),
        ts.list_array(lo[by].view(np.int64), counts[full], pa.int64()), ts.list_array(hi[by], counts[full], pa.int32())],
        names=["bucket", "chunk", "lo", "hi"])


DEALT_DDL = "bucket long, chunk long, lo array<long>, hi array<int>"


def _repeated(table: pa.Table) -> pa.Table:
    """A bucket's values that stand twice or more, for each chunk that has them: (chunk, lo)."""
    t = table.combine_chunks()
    chunks = t.column("chunk").to_numpy()
    lists = t.column("lo").chunk(0) if t.num_rows else None
    lo = np.asarray(lists.flatten())
    hi = np.asarray(t.column("hi").chunk(0).flatten())
    row = np.repeat(np.arange(len(chunks)), np.diff(np.asarray(lists.offsets)))
    order = np.lexsort((hi, lo))
    same = (lo[order][1:] == lo[order][:-1]) & (hi[order][1:] == hi[order][:-1])
    many = np.zeros(len(lo), dtype=bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    row, lo = row[many], lo[many]
    by = np.argsort(row, kind="stable")
    counts = np.bincount(row, minlength=len(chunks))
    full = np.flatnonzero(counts)
    out = ts.list_array(lo[by], counts[full], pa.int64())
    return pa.Table.from_arrays([pa.array(chunks[full], pa.int64()), out], names=["chunk", "lo"])


def _symbol_dealer(buckets: int, window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                _, w = _unpack(b.slice(i, 1))
                sym, first, end = parse(w.hash, w.doc, rounds)
                sym = sym[end - first <= window]
                yield _deal(b.column(0)[i].as_py(), buckets, sym, np.zeros(len(sym), dtype=np.int32))
    return run


def _values(table: pa.Table) -> np.ndarray:
    parts = [np.asarray(c.flatten()) for c in table.column("lo").chunks]
    return np.unique(np.concatenate(parts).view(U64)) if parts else np.zeros(0, U64)


def _window_dealer(buckets: int, window: int, rounds: int):
    def run(chunk: pa.Table, shared: pa.Table) -> pa.Table:
        empty = pa.Table.from_batches([_deal(0, buckets, np.zeros(0, U64), np.zeros(0, np.int32))])
        if not chunk.num_rows:
            return empty
        _, w = _unpack(chunk)
        at = candidates(w, window, _values(shared), rounds)
        if not len(at):
            return empty
        every, lo = w.windows(window)
        _, hi = w.windows(window, salt=1)
        pick = np.searchsorted(every, at)
        return pa.Table.from_batches([_deal(chunk.column("chunk")[0].as_py(), buckets, lo[pick], (hi[pick] >> U64(33)).astype(np.int32))])
    return run


def _remover(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(chunk: pa.Table, repeated: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return schema.empty_table()
        ids, w = _unpack(chunk)
        n = len(w.hash)
        at, lo = w.windows(window)
        values = _values(repeated)
        hit = at[values[np.minimum(np.searchsorted(values, lo), len(values) - 1)] == lo] if len(values) else at[:0]
        edge = np.zeros(n + window + 1, dtype=np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        gone = np.cumsum(edge[:n]) > 0
        removed = np.bincount(w.doc[gone], minlength=w.n_texts)
        keep = ~gone
        lens = (w.ends - w.starts)[keep]
        mark = np.zeros(len(w.data) + 1, dtype=np.int8)
        mark[w.starts[keep]] += 1
        mark[w.ends[keep]] -= 1
        body = w.data[np.cumsum(mark[:-1], dtype=np.int8) > 0]
        out = np.full(len(body) + len(lens), 0x20, dtype=np.uint8)
        out[np.arange(len(body)) + np.repeat(np.arange(len(lens)), lens)] = body
        per = np.bincount(w.doc[keep], weights=lens + 1, minlength=w.n_texts).astype(np.int64)
        at = np.append(0, np.cumsum(per))
        raw = out.tobytes()
        texts = [raw[s:max(s, e - 1)].decode() for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.Table.from_arrays([ids.cast(pa.int64()), pa.array(w.counts, pa.int64()), pa.array(removed, pa.int64()),
                                     pa.array(texts, pa.string())], schema=schema)
    return run


def _digester(inner):
    def run(chunk: pa.Table, repeated: pa.Table) -> pa.Table:
        t = inner(chunk, repeated)
        digest = [hashlib.sha256(x.as_py().encode()).hexdigest() for x in t.column("kept")]
        return t.set_column(3, "kept", pa.array(digest, pa.string()))
    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, digest: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A word goes if a run of ``window`` words that covers it also starts anywhere else, in the same document or
    another; words are split at ASCII white space and compared as they stand. With ``digest``, kept is the lower-case
    hex SHA-256 of that text.

    Null, empty and wordless texts have no words; texts of fewer than ``window`` words lose none. Repeated rows are
    documents of their own and empty each other if they are long enough. Null doc_ids come back as they are; an empty
    table gives an empty result; other columns are ignored. A text of any length is one chunk at most.
    """
    st = Stage(spark, "recompression")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    chunks = st.put("chunks", rows.mapInArrow(_packer, CHUNK_DDL))
    words = chunks.agg(F.sum("words")).first()[0] or 0
    deal = lambda n: parts_for(spark, n, BUCKET_VALUES)
    by_chunk = chunks.groupBy("chunk")
    found = lambda t: t.groupBy("bucket").applyInArrow(_repeated, "chunk long, lo array<long>")
    symbols = chunks.select("chunk", "lens", "doc_ids", "blob").mapInArrow(_symbol_dealer(deal(words // 4), window, rounds), DEALT_DDL)
    shared = st.put("shared", found(symbols))
    windows = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_window_dealer(deal(words), window, rounds), DEALT_DDL)
    repeated = st.put("repeated", found(windows))
    finish = _digester(_remover(window)) if digest else _remover(window)
    return by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(finish, "doc_id long, n_words long, n_removed long, kept string")
