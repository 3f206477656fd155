"""Toxic spans by a linear-chain conditional random field (operator 4).

Words are runs of letters and digits, lower-cased; a word's features are itself and its beginnings of 4 to 7 bytes, as
far as these tell toxic from other labelled documents. In a labelled toxic document the words that have such a feature
are the toxic tokens, all other words of labelled documents are not; on these tokens the field's weights are fitted
by its likelihood. Only documents carry labels; neither labels nor lang, source or doc_id enter a score.

Scoring runs forward-backward over every word of a text. Words without a feature share one transition matrix, so a run
of them is a power of it, taken by its eigenvalues: time follows the words that have a feature. Marginals give the
offending offsets; their sum, their largest and the length of the text give the score by a logistic calibration
that is fitted on the training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .stage import text_or_empty

#: The fit's sample: labelled rows of each class, by the order of a hash, of texts up to a number of bytes.
MAX_TOXIC, MAX_OTHER, MAX_BYTES = 1500, 3500, 8_000
PREFIXES = (4, 5, 6, 7)
MAX_FEATURES = 4000
MIN_DOCS = 4
MIN_LOG_ODDS = 2.0
MIN_G2 = 15.0  # log-likelihood ratio against a feature that is as frequent in both classes
TOXIC_TOKEN_LOG_ODDS = 3.0
THRESHOLD = 0.7
SEGMENT = 32
#: Segments that the field's weights are fitted on, half of them without any feature.
MAX_SEGMENTS = 6000


def feature_hashes(w: ts.Words) -> Iterator[np.ndarray]:
    """One array of a feature of every word at a time: the word, its beginnings; 0 where it is not longer than one."""
    yield w.hash
    size = w.ends - w.starts
    for n in PREFIXES:
        out = np.zeros(len(w.hash), dtype=np.uint64)
        some = np.flatnonzero(size > n)
        out[some] = ts.span_hashes(w.data, w.starts[some], w.starts[some] + n, lower=True) ^ ts.U64(n)
        yield out


def scan(texts: pa.Array) -> ts.Words:
    return ts.Words(texts, lower=True, separators=ts.NOT_ALNUM)


@dataclass
class Model:
    """Weights of the field and of the calibration; ``keys`` ascend and go with ``weights``."""
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    calibration: np.ndarray

    def __post_init__(self):
        self.table = np.zeros(1 << 16, dtype=bool)
        self.table[(self.keys & ts.U64(0xFFFF)).astype(np.int64)] = True

    def find(self, w: ts.Words) -> tuple[np.ndarray, np.ndarray]:
        """(words that have a feature of the model, the indices of their features, -1 for none)."""
        places, kinds, keys = [], [], []
        for j, h in enumerate(feature_hashes(w)):
            if not len(self.keys):
                break
            maybe = np.flatnonzero(self.table[(h & ts.U64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
            good = self.keys[at] == h[maybe]
            places.append(maybe[good])
            keys.append(at[good])
            kinds.append(np.full(int(good.sum()), j))
        if not places:
            return np.zeros(0, np.int64), np.zeros((0, 1 + len(PREFIXES)), np.int64)
        places, kinds, keys = np.concatenate(places), np.concatenate(kinds), np.concatenate(keys)
        hit, row = np.unique(places, return_inverse=True)
        found = np.full((len(hit), 1 + len(PREFIXES)), -1, dtype=np.int64)
        found[row, kinds] = keys
        return hit, found


def _one_of_copies(w: ts.Words, rare: int = 30) -> np.ndarray:
    """Marks one text of each group of near copies, so that a copied text's words don't count as evidence many times:
    texts are grouped by the smallest hash among their words that at most ``rare`` texts hold."""
    word, doc = _distinct(w.hash, w.doc)
    _, inverse, df = np.unique(word, return_inverse=True, return_counts=True)
    few = df[inverse] <= rare
    key = np.full(w.n_texts, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(key, doc[few], word[few])
    none = key == np.iinfo(np.uint64).max
    first = np.zeros(w.n_texts, dtype=bool)
    first[np.unique(key, return_index=True)[1]] = True
    return first | none


def _select(w: ts.Words, toxic: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, log odds) of the features that mark toxic documents among those of ``own``, ascending by key."""
    n1, n0 = int((toxic & own).sum()), int((~toxic & own).sum())
    share = n1 / max(n1 + n0, 1)
    some = own[w.doc]
    doc = w.doc[some]
    keys, odds, rank = [], [], []
    for h in feature_hashes(w):  # one kind of feature at a time: their hashes never meet
        key, where = _distinct(h[some], doc)
        if not len(key):
            continue
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        a = np.add.reduceat(toxic[where].astype(float), new)
        b = np.add.reduceat((~toxic[where]).astype(float), new)
        log_odds = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
        g2 = 2 * (a * np.log(np.maximum(a, 1) / ((a + b) * share)) + b * np.log(np.maximum(b, 1) / ((a + b) * (1 - share))))
        good = np.flatnonzero((a >= MIN_DOCS) & (log_odds >= MIN_LOG_ODDS) & (g2 >= MIN_G2))
        keys.append(key[new][good])
        odds.append(log_odds[good])
        rank.append((log_odds * np.sqrt(a))[good])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0)
    keys, odds, rank = np.concatenate(keys), np.concatenate(odds), np.concatenate(rank)
    best = np.argsort(-rank, kind="stable")[:MAX_FEATURES]
    best = best[np.argsort(keys[best])]
    return keys[best], odds[best]


def _distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some = h != 0
    h, doc = h[some], doc[some]
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def _fit_field(row: np.ndarray, found: np.ndarray, label: np.ndarray, first: np.ndarray, size: np.ndarray, n_keys: int, steps: int = 80):
    """Weights by gradient ascent on the likelihood of labelled segments: words first[i] .. first[i] + size[i] - 1.
    ``row`` is a word's row in ``found`` and ``label``, their last row stands for words without a feature."""
    place = first[:, None] + np.arange(SEGMENT)[None, :]
    inside = np.arange(SEGMENT)[None, :] < size[:, None]
    place = np.where(inside, place, 0)
    at = np.where(inside, row[place], len(found) - 1)
    feats, y = found[at], label[at]
    w, bias, trans = np.zeros(n_keys + 1), -1.0, np.zeros((2, 2))
    moments = [[np.zeros_like(w), np.zeros_like(w)], [0.0, 0.0], [np.zeros((2, 2)), np.zeros((2, 2))]]
    gold_f = np.bincount(feats[(y == 1)].ravel() + 1, minlength=n_keys + 1).astype(float)
    gold_b = float((y * inside).sum())
    gold_t = np.zeros((2, 2))
    before = np.concatenate([np.zeros((len(y), 1), int), y[:, :-1]], axis=1)
    np.add.at(gold_t, (before[inside], y[inside]), 1)
    scale = max(1.0, inside.sum() / 100)
    for step in range(1, steps + 1):
        ww = w.copy()
        ww[0] = 0
        unary = np.clip(bias + ww[feats + 1].sum(2), -30, 30)
        e = np.stack([np.ones_like(unary), np.exp(unary)], -1)
        t = np.exp(trans)
        alpha = np.zeros(e.shape)
        cur = np.tile([1.0, 0.0], (len(y), 1))
        for k in range(SEGMENT):
            nxt = (cur @ t) * e[:, k]
            nxt /= nxt.sum(1, keepdims=True)
            cur = np.where(inside[:, k:k + 1], nxt, cur)
            alpha[:, k] = cur
        beta = np.ones((len(y), 2))
        exp_f, exp_b, exp_t = np.zeros(n_keys + 1), 0.0, np.zeros((2, 2))
        for k in range(SEGMENT - 1, -1, -1):
            live = inside[:, k]
            prev = alpha[:, k - 1] if k else np.tile([1.0, 0.0], (len(y), 1))
            joint = prev[:, :, None] * t[None] * (e[:, k] * beta)[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            exp_t += joint[live].sum(0)
            p = joint.sum(1)[:, 1] * live
            exp_b += p.sum()
            exp_f += np.bincount(feats[:, k].ravel() + 1, weights=np.repeat(p, feats.shape[2]), minlength=n_keys + 1)
            back = (e[:, k] * beta) @ t.T
            beta = np.where(live[:, None], back / back.sum(1, keepdims=True), beta)
        grads = [(gold_f - exp_f - 0.05 * w) / scale, (gold_b - exp_b) / scale, (gold_t - exp_t - 0.05 * trans) / scale]
        values = [w, bias, trans]
        for i, g in enumerate(grads):
            moments[i][0] = 0.9 * moments[i][0] + 0.1 * g
            moments[i][1] = 0.99 * moments[i][1] + 0.01 * g * g
            rise = 0.1 * (moments[i][0] / (1 - 0.9 ** step)) / (np.sqrt(moments[i][1] / (1 - 0.99 ** step)) + 1e-6)
            values[i] = values[i] + rise
        w, bias, trans = values
    return w[1:], float(bias), trans


def tag(model: Model, w: ts.Words) -> tuple[np.ndarray, np.ndarray]:
    """(words with a feature, marginal probability that each is toxic): forward-backward over the whole texts."""
    hit, found = model.find(w)
    if not len(hit):
        return hit, np.zeros(0)
    weights = np.append(model.weights, 0.0)
    unary = np.clip(model.bias + weights[found].sum(1), -30, 30)
    emit = np.stack([np.ones(len(hit)), np.exp(unary)], 1)
    t = np.exp(model.trans)
    plain = t * np.array([1.0, np.exp(np.clip(model.bias, -30, 30))])[None, :]
    values, vectors = np.linalg.eig(plain)
    order = np.argsort(-np.abs(values))
    values, vectors = values[order].real, vectors[:, order].real
    inverse, ratio = np.linalg.inv(vectors), values[1] / values[0]

    def power(g: np.ndarray) -> np.ndarray:
        """plain ** g, up to a factor."""
        d = np.ones((len(g), 2))
        d[:, 1] = ratio ** np.minimum(g, 10_000)
        return np.einsum("ij,nj,jk->nik", vectors, d, inverse)

    doc = w.doc[hit]
    docs, at, count = np.unique(doc, return_index=True, return_counts=True)
    gap_before = hit - np.where(np.arange(len(hit)) > np.repeat(at, count), np.append(0, hit[:-1]) + 1, w.first[doc])
    gap_after = w.first[docs + 1] - 1 - hit[at + count - 1]
    alpha, beta = np.zeros((len(hit), 2)), np.ones((len(hit), 2))
    cur = np.tile([1.0, 0.0], (len(docs), 1))
    by_size = np.argsort(-count, kind="stable")  # documents with a k-th hit come first
    at, count = at[by_size], count[by_size]
    for k in range(int(count[0])):
        live = int(np.searchsorted(-count, -k, "left"))
        i = at[:live] + k
        step = np.einsum("ni,nij->nj", cur[:live], power(gap_before[i])) @ t * emit[i]
        step = np.maximum(step, 1e-300)
        cur[:live] = step / step.sum(1, keepdims=True)
        alpha[i] = cur[:live]
    back = np.einsum("nij,j->ni", power(gap_after[by_size]), np.ones(2))
    for k in range(int(count[0]) - 1, -1, -1):
        live = int(np.searchsorted(-count, -k, "left"))
        i = at[:live] + k
        beta[i] = back[:live]
        step = np.einsum("nij,nj->ni", power(gap_before[i]), (emit[i] * back[:live]) @ t.T)
        step = np.maximum(step, 1e-300)
        back[:live] = step / step.sum(1, keepdims=True)
    joint = alpha * beta
    return hit, joint[:, 1] / joint.sum(1)


def _aggregate(w: ts.Words, hit: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(texts, 4): 1, log of the words, log of the expected toxic words, largest marginal."""
    x = np.zeros((w.n_texts, 4))
    x[:, 0] = 1
    x[:, 1] = np.log1p(w.counts) / 10
    x[:, 2] = np.log1p(np.bincount(w.doc[hit], weights=p, minlength=w.n_texts))
    np.maximum.at(x[:, 3], w.doc[hit], p)
    return x


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    b = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-9)
        b = b + np.linalg.solve(hess, x.T @ (y - p) - keep * b)
    return b


def fit(texts: pa.Array, toxic: np.ndarray) -> Model:
    """Fit on labelled texts; without both classes the model scores all texts by the share of the one there is."""
    toxic = np.asarray(toxic, dtype=bool)
    w = scan(texts)
    none = Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, np.zeros((2, 2)), np.array([-3.0, 0, 0, 0]))
    if not len(toxic) or toxic.all() or not toxic.any():
        none.calibration[0] = 3.0 if len(toxic) and toxic.all() else -3.0
        return none
    keys, odds = _select(w, toxic, _one_of_copies(w))
    if not len(keys):
        return none
    hit, found = Model(keys, np.zeros(len(keys)), 0.0, np.zeros((2, 2)), np.zeros(4)).find(w)
    strong = np.append(odds >= TOXIC_TOKEN_LOG_ODDS, False)
    label = np.append((strong[found].any(1) & toxic[w.doc[hit]]).astype(int), 0)
    row = np.full(len(w.hash), len(hit), dtype=np.int32)
    row[hit] = np.arange(len(hit))
    first = np.concatenate([np.arange(a, b, SEGMENT) for a, b in zip(w.first[:-1], w.first[1:])])
    size = np.minimum(SEGMENT, w.first[w.doc[first] + 1] - first)
    active = np.bincount(np.searchsorted(first, hit, "right") - 1, minlength=len(first)) > 0
    spread = lambda x: x[::max(1, -(-len(x) * 2 // MAX_SEGMENTS))]
    use = np.sort(np.concatenate([spread(np.flatnonzero(active)), spread(np.flatnonzero(~active))]))
    none_found = np.full((1, found.shape[1]), -1, dtype=np.int64)
    weights, bias, trans = _fit_field(row, np.concatenate([found, none_found]), label, first[use], size[use], len(keys))
    model = Model(keys, weights, bias, trans, np.zeros(4))
    model.calibration = _logistic(_aggregate(w, *tag(model, w)), toxic.astype(float))
    return model


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels the fit never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of labelled documents that are not held out: of each class the first ``MAX_TOXIC`` or
    ``MAX_OTHER`` doc_ids by a hash, as far as ``docs`` has them with at most ``MAX_BYTES`` bytes of text. Null labels
    are no labels. The sample's doc_ids are chosen from the labels alone and broadcast, its texts go to
    one task for the fit; no other text is shuffled."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.withColumn("place", F.xxhash64(F.col("doc_id").cast("string")))
    chosen = [marks.where(c).orderBy("place", "doc_id").limit(n).select("doc_id", F.lit(y).alias("y"))
              for c, n, y in (("toxic > 0", MAX_TOXIC, 1), ("toxic <= 0", MAX_OTHER, 0))]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # at most MAX_TOXIC + MAX_OTHER rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.where(F.octet_length("text") <= MAX_BYTES).join(sample, "doc_id").dropDuplicates(["doc_id"])
    fitted = rows.select("doc_id", "text", "y").repartition(1).mapInArrow(_fitter, MODEL_DDL).first()  # one task, of the bounded sample
    if fitted is None:  # no partition at all
        return fit(pa.array([], pa.string()), np.zeros(0, bool))
    return Model(np.array(fitted["keys"], np.int64).view(np.uint64), np.array(fitted["weights"]), fitted["bias"],
                 np.array(fitted["trans"]).reshape(2, 2), np.array(fitted["calibration"]))


MODEL_DDL = "keys array<long>, weights array<double>, bias double, trans array<double>, calibration array<double>"


def _fitter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if got:
        t = pa.Table.from_batches(got).sort_by("doc_id")
        m = fit(t.column("text").combine_chunks(), t.column("y").to_numpy() == 1)
    else:
        m = fit(pa.array([], pa.string()), np.zeros(0, bool))
    many = lambda x, kind: pa.array([x.tolist()], pa.list_(kind))
    yield pa.RecordBatch.from_arrays([many(m.keys.view(np.int64), pa.int64()), many(m.weights, pa.float64()), pa.array([float(m.bias)]),
                                      many(m.trans.ravel(), pa.float64()), many(m.calibration, pa.float64())],
                                     names=["keys", "weights", "bias", "trans", "calibration"])


SCORE_DDL = "doc_id long, score double, spans array<struct<start:long,end:long>>"


def _scorer(parts: tuple):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*parts)
        for b in ts.pieces(batches, "text"):
            w = scan(b.column(1))
            hit, p = tag(model, w)
            score = 1 / (1 + np.exp(-np.clip(_aggregate(w, hit, p) @ model.calibration, -30, 30)))
            bad = hit[p >= 0.5]
            base = w.text_at[w.doc[bad]]
            counts = np.bincount(w.doc[bad], minlength=w.n_texts)
            spans = pa.StructArray.from_arrays([pa.array(w.starts[bad] - base), pa.array(w.ends[bad] - base)], names=["start", "end"])
            at = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.ListArray.from_arrays(at, spans)], schema=schema)
    return run


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.7), spans.

    spans are the offending words' offsets in the UTF-8 text. Null and empty texts have no words and get the score of
    such a text; null doc_ids are scored and not held out; repeated rows get equal scores. Without labels of both
    classes nothing is learnt and every text gets one score. Empty tables give an empty result, other columns are
    ignored. Texts are scored whole.
    """
    m = model or train(spark, docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = rows.mapInArrow(_scorer((m.keys, m.weights, m.bias, m.trans, m.calibration)), SCORE_DDL)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text and any other columns) without the rows that score at the threshold or above.

    The whole rows pass through the scorer, so texts are not shuffled and rows without or with equal doc_ids are
    judged one by one.
    """
    parts = (model.keys, model.weights, model.bias, model.trans, model.calibration)
    at = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*parts)
        for b in ts.pieces(batches, names[at]):
            w = scan(b.column(at))
            score = _aggregate(w, *tag(m, w)) @ m.calibration
            yield b.filter(pa.array(score < np.log(THRESHOLD / (1 - THRESHOLD))))

    plain = docs.toDF(*names)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
