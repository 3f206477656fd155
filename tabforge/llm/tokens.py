"""Token ids in Parquet list columns (operator 10).

Documents are written in ascending doc_id order as rows (doc_id, tie, n_tokens, ids). ``ids`` is a list column with
delta or dictionary encoding; row groups and pages are small and carry page indexes, so a reader that asks for some
documents, or for the metadata columns only, reads little else. ``tie`` orders rows that have one doc_id.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .prefix import running_sums
from .stage import Stage, text_or_empty

#: Slots (16 bytes each) and ids (4 bytes) of the words that each Python worker keeps; beyond it starts anew.
TABLE_BITS = 20
MAX_IDS = 8 << 20
MARKED = 0x5851F42D4C957F2D
_READY: dict = {}

ENCODINGS = {
    "delta": {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"},
    "dictionary": {"parquet.writer.version": "v2", "parquet.enable.dictionary": "true"},
}


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level models write for bytes: printable Latin-1 as it is, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _plain(word: str) -> str | None:
    """What the model sees of a word that is one run of letters; None if the whole tokenizer is needed."""
    if word.isascii():
        return word.lower() if word.isalpha() else None
    low = "".join(c.lower() for c in word)
    if low.isalpha() and is_normalized("NFC", word) and is_normalized("NFC", low):
        return low.encode().decode("latin-1").translate(_LETTERS)
    return None


# fixed values: the normalizer and the cuts that the word table below rests on
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITS = [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
          {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


def works_by_words(tokenizer) -> bool:
    """Are the ids of a text those of its words, lower-cased and cut as :func:`encode_texts` cuts them?"""
    t = json.loads(tokenizer.to_str())
    return ((t["normalizer"] or {}).get("normalizers") == NORMALIZERS and (t["pre_tokenizer"] or {}).get("pretokenizers") == SPLITS and not t["model"].get("dropout")
            and all("<|" in a["content"] and not (a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"]) for a in t["added_tokens"]))


def encode_texts(texts: pa.Array, tokenizer, cache: "WordIds", end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of whole texts, ``end_id`` appended to each.

    Any tokenizer but one of a known form encodes the texts whole. One of that form lower-cases, drops white space and never joins what stands on both sides of it, nor a letter with
    a digit or a sign other than an apostrophe. So the ids of a text are those of its words, cut at these places, one
    after another; each distinct piece is encoded once and looked up by its hash afterwards. Words with ``<|`` may
    hold a special token: they stay whole and keep their case.
    """
    if cache.by_words is None:
        cache.by_words = works_by_words(tokenizer)
    if not cache.by_words:
        every = [[*e.ids, end_id] for e in tokenizer.encode_batch([x or "" for x in texts.to_pylist()], add_special_tokens=False)]
        return np.array([i for ids in every for i in ids], dtype=np.int32), np.array([len(ids) for ids in every], dtype=np.int64)
    w = ts.Words(texts, lower=True, split=True)
    if len(w.marked):
        w.hash[w.marked] = ts.span_hashes(w.data, w.starts[w.marked], w.ends[w.marked]) ^ ts.U64(MARKED)
    at, lens = cache.places(w, tokenizer)
    # each text is its words and one more piece, the end id
    per_text = np.bincount(w.doc, weights=lens, minlength=w.n_texts).astype(np.int64) + 1
    out = np.full(int(per_text.sum()), end_id, dtype=np.int32)
    if len(lens):
        before = np.cumsum(lens) - lens
        step = np.arange(int(lens.sum()))
        out[step + np.repeat(w.doc, lens)] = cache.ids[step + np.repeat(at - before, lens)]
    return out, per_text


class WordIds:
    """Ids of words seen so far: a direct-mapped table by hash, a dict for hashes whose slot is taken, one array of ids."""

    by_words: bool | None = None

    def __init__(self, bits: int = TABLE_BITS):
        self.shift = ts.U64(64 - bits)
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.at = np.zeros(1 << bits, dtype=np.int32)
        self.lens = np.zeros(1 << bits, dtype=np.int32)
        self.ids, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.more: dict[int, tuple[int, int]] = {}

    def _add(self, ids: list[int]) -> int:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def places(self, w: ts.Words, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """(first, number) in ``ids`` of each word's ids; words not seen before are encoded."""
        if self.used > MAX_IDS:
            self.__init__(64 - int(self.shift))
        slot = (w.hash >> self.shift).astype(np.int64)
        at, lens = self.at[slot].astype(np.int64), self.lens[slot].astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != w.hash)
        if len(miss):
            keys, first, inverse = np.unique(w.hash[miss], return_index=True, return_inverse=True)
            names = keys.tolist()
            got = [self.more.get(k) for k in names]
            new = [i for i, g in enumerate(got) if g is None]
            places = miss[first[new]]
            raw = w.data.tobytes() if len(new) > 50 else w.data
            words = [bytes(raw[s:e]).decode("utf-8") for s, e in zip(w.starts[places].tolist(), w.ends[places].tolist())]
            slots = slot[places].tolist()
            for i, s, ids in zip(new, slots, _encode_words(words, tokenizer)):
                got[i] = (self._add(ids), len(ids))
                if not self.keys[s]:
                    self.keys[s], (self.at[s], self.lens[s]) = names[i], got[i]
                else:
                    self.more[names[i]] = got[i]
            pair = np.array(got, dtype=np.int64)[inverse]
            at[miss], lens[miss] = pair[:, 0], pair[:, 1]
        return at, lens


def _encode_words(words: list[str], tokenizer) -> list[list[int]]:
    plain = [_plain(x) for x in words]
    hard = iter(tokenizer.encode_batch([x for x, p in zip(words, plain) if p is None], add_special_tokens=False))
    model = tokenizer.model
    return [next(hard).ids if p is None else [t.id for t in model.tokenize(p)] for p in plain]


def _encoder(model: str, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if _READY.get("model") != model:
            _READY.update(model=model, tokenizer=Tokenizer.from_str(model), cache=WordIds())
        for b in ts.pieces(batches, "text"):
            ids, counts = encode_texts(b.column(2), _READY["tokenizer"], _READY["cache"], end_id)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts), ts.list_array(ids, counts, pa.int32())], schema=schema)
    return run


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1,
                 encoding: str = "delta", row_group_bytes: int = 8 << 20, page_rows: int = 200, parts: int | None = None) -> None:
    """Encode the texts of ``docs`` (doc_id, text) and write them at ``path`` in ascending doc_id order.

    Null and empty texts have the end id alone. Null doc_ids come first; rows with one doc_id stand in the order of
    a hash of their text. An empty table writes files without rows. ``tokenizer_path`` is read by the driver only.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("tie"), text_or_empty().alias("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    out = rows.mapInArrow(_encoder(model, end_id), "doc_id long, tie long, n_tokens long, ids array<int>")
    options = ENCODINGS[encoding] | {"parquet.block.size": str(row_group_bytes), "parquet.page.row.count.limit": str(page_rows),
                                     "parquet.page.write-checksum.enabled": "true", "compression": "zstd"}
    out.write.mode("overwrite").options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None, where=None) -> DataFrame:
    """Some columns of some documents: conditions on doc_id select row groups and pages by their statistics."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*(columns or ["doc_id", "n_tokens", "ids"]))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column(2)
        at = np.asarray(col.offsets)
        ids = np.asarray(col.values).astype("<u4", copy=False)
        crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                                         names=["doc_id", "tie", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start (ids of all earlier documents), n_tokens, ids_crc32 (unsigned)."""
    st = Stage(spark, "token-digests")
    read = read_tokens(spark, path, ["doc_id", "tie", "ids"])
    rows = st.put("digests", read.mapInArrow(_digest, "doc_id long, tie long, n_tokens long, ids_crc32 long"))
    out, _ = running_sums(st, rows, ["doc_id", "tie"], "n_tokens")
    return out.select("doc_id", F.col("before").alias("start"), "n_tokens", "ids_crc32")
