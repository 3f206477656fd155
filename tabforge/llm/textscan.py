"""Words of Arrow string columns as 64-bit hashes, found with whole-array numpy operations.

A word is a maximal run of bytes that are not separators. The default separators are the ASCII white space
``\\x20 \\x09-\\x0D``; UTF-8 keeps these bytes out of longer characters, so the scan works on bytes. Texts are
scanned whole; long ones piece by piece, cut between words, so that memory follows the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
PIECE = 1 << 20
BATCH_BYTES = 2 << 20

_POWERS: dict[str, np.ndarray] = {}


def _bytes_mask(values) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[list(values)] = True
    return mask


SPACE = _bytes_mask([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: All ASCII but letters and digits: words are then runs of letters, digits and non-ASCII bytes.
NOT_ALNUM = _bytes_mask(b for b in range(128) if not chr(b).isalnum())

#: ASCII letters 1, digits and signs but the apostrophe 2, white space and controls 0, others 5.
KIND = np.full(256, 5, dtype=np.uint8)
KIND[:128] = [1 if chr(b).isalpha() else 5 if b == 0x27 else 2 if 0x20 < b < 0x7F else 0 for b in range(128)]

_rng = np.random.Generator(np.random.PCG64(20240607))
_CODES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[65:91] = _CODES[97:123]
_BASE = int(_rng.integers(0, 1 << 61)) * 8 + 5
_STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        n = max(n, PIECE)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            a = np.full(n, base, dtype=U64)
            a[0] = 1
            _POWERS[name] = np.cumprod(a, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each byte span; spans ascend and don't overlap."""
    codes = _LOWER_CODES if lower else _CODES
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        seg = data[base:int(ends[j - 1])]
        up, down = _powers(len(seg) + 1)
        sums = np.zeros(len(seg) + 1, dtype=U64)
        np.cumsum(codes[seg] * up[:len(seg)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(U64) * _STEP)


class Words:
    """Words of the texts of one batch. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    def __init__(self, texts: pa.Array, lower: bool = False, separators: np.ndarray = SPACE, split: bool = False):
        """split: also cut words where an ASCII letter meets an ASCII digit or sign other than an apostrophe, unless the
        word holds ``<|``; ``marked`` has the indices of the words that do."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        lo = int(offsets[0]) if len(offsets) else 0
        hi = int(offsets[-1]) if len(offsets) else 0
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, dtype=np.uint8)[lo:hi] if raw is not None else np.zeros(0, np.uint8)
        self.text_at = offsets - lo
        self.n_texts = len(texts)
        gap = separators[self.data]
        ink = ~gap
        begin, end = ink.copy(), ink.copy()
        begin[1:] &= gap[:-1]
        end[:-1] &= gap[1:]
        full = np.flatnonzero(self.text_at[1:] > self.text_at[:-1])
        begin[self.text_at[full]] = ink[self.text_at[full]]
        end[self.text_at[full + 1] - 1] = ink[self.text_at[full + 1] - 1]
        self.marked = np.zeros(0, dtype=np.int64)
        held = ()
        if split:
            kind = KIND[self.data]
            cut = kind[1:] * kind[:-1] == 2
            held = np.flatnonzero(self.data[:-1] == 0x3C)
            held = held[self.data[held + 1] == 0x7C]
            if len(held):
                starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
                for i in np.unique(np.searchsorted(starts, held, "right") - 1):
                    cut[starts[i]:ends[i] - 1] = False
            begin[1:] |= cut
            end[:-1] |= cut
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        if len(held):
            self.marked = np.unique(np.searchsorted(self.starts, held, "right") - 1)
        self.first = np.searchsorted(self.starts, self.text_at)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_texts), self.counts)
        self.gap = gap
        self.hash = span_hashes(self.data, self.starts, self.ends, lower)

    def windows(self, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of its first word, hash) of each run of ``size`` words of one text."""
        return run_hashes(self.hash, self.doc, size, salt)


def run_hashes(h: np.ndarray, doc: np.ndarray, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first, hash) of each run of ``size`` items that have one ``doc``; ``salt`` varies the hash."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    if salt:
        h = mix(h + U64(salt * int(_STEP) % (1 << 64)))
    total = np.empty(n, dtype=U64)
    for lo in range(0, n, PIECE):
        hi = min(n, lo + PIECE)
        m = hi - lo + size - 1
        up, down = _powers(m + 1)
        sums = np.zeros(m + 1, dtype=U64)
        np.cumsum(h[lo:lo + m] * up[:m], out=sums[1:])
        total[lo:hi] = (sums[size:] - sums[:m - size + 1]) * down[:m - size + 1]
    at = np.flatnonzero(doc[:n] == doc[size - 1:])
    return at, mix(total[at] + U64(size * int(_STEP) % (1 << 64)))


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``limit`` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        at = np.append(0, np.cumsum(size, dtype=np.int64))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    at = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, type=kind))
