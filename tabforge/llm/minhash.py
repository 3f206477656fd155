"""Near-duplicate classes by bottom-k sketches (operator 1).

One 64-bit hash names every shingle. A document keeps its ``k`` smallest hashes (the bottom-k sketch). Documents
whose similarity reaches the threshold share many retained values: of the ``k`` smallest values of their union a
hypergeometric number lies in both. ``_least_shared`` is the number that a similar pair misses with probability
under 1e-9 at most; documents with at most ``k`` shingles keep their whole set, so their bound is exact.

1. Documents with equal shingle sets fall together; one stands for them from here on.
2. A first look at the 16 smallest values drops documents that share fewer than two of them with any other.
3. Inverted lists of the retained values. Lists are only needed for a document's rarest values: if two sketches
   share ``c`` values, the first ``size - c + 1`` in any common order already share one (prefix filter, by rising
   frequency). Passages that many documents hold thus stay out of the lists of documents that have enough else.
4. Round 1 pairs every member of a list with its smallest and its largest document only. Union-sketch estimation
   filters these pairs, exact Jaccard on the full sets verifies them, and components follow.
5. Round 2 takes the documents of lists that still hold several components and does the same with their whole sets
   (the exact way for what a sketch leaves open): lists of rare values, and a pair only where the components differ,
   the sizes allow the similarity and enough values stand behind the common one in both orders (position filter).
   Lists within one component - the large groups of copies - make no pairs, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .components import connected_components
from .stage import Stage, only, text_or_empty

SHINGLE = 5
SIMILARITY_PERCENT = 75
K = 128
FIRST_LOOK = 16
MISS = 1e-9


def least_shared(k: int, percent: int = SIMILARITY_PERCENT, miss: float = MISS) -> int:
    """Largest c with P(fewer than c of k values of the union are shared) <= miss at the threshold."""
    p, below, c = percent / 100, 0.0, 0
    while c < k:
        below += comb(k, c) * p ** c * (1 - p) ** (k - c)
        if below > miss:
            break
        c += 1
    return c


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(values, counts): the distinct shingle hashes of each text, ascending, as int64.

    Words are split at ASCII white space and A-Z lower-cased. A text of 1 to size-1 words has its whole sequence as
    its one shingle; a text without words has none.
    """
    w = ts.Words(texts, lower=True)
    at, h = w.windows(size)
    docs, values = [w.doc[at]], [h.view(np.int64)]
    for n in range(1, size):
        short = np.flatnonzero(w.counts == n)
        if len(short):
            first = w.first[short]
            hs = np.concatenate([w.hash[i:i + n] for i in first])
            _, g = ts.run_hashes(hs, np.repeat(np.arange(len(short)), n), n)
            docs.append(short)
            values.append(g.view(np.int64))
    doc, value = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[keep], np.bincount(doc[keep], minlength=w.n_texts)


SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                    ("look", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])
SKETCH_DDL = "doc_id long, n_shingles long, d1 long, d2 long, look array<long>, sketch array<long>"


def _sketcher(k: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.pieces(batches, "text"):
            values, counts = shingle_sets(b.column(1), size)
            at = np.concatenate([[0], np.cumsum(counts)])
            rank = np.arange(len(values)) - np.repeat(at[:-1], counts)
            digests = np.empty((len(counts), 2), dtype=np.int64)
            for i in range(len(counts)):
                digests[i] = np.frombuffer(hashlib.blake2b(values[at[i]:at[i + 1]].tobytes(), digest_size=16).digest(), np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(counts, pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                ts.list_array(values[rank < FIRST_LOOK], np.minimum(counts, FIRST_LOOK), pa.int64()),
                ts.list_array(values[rank < k], np.minimum(counts, k), pa.int64())], schema=SKETCH)
    return run


def _verifier(size: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.pieces(batches, "tb"):  # both sizes are near, so this bounds the other text as well
            (x, nx), (y, ny) = shingle_sets(b.column(2), size), shingle_sets(b.column(3), size)
            rows = np.arange(b.num_rows)
            row, value = np.concatenate([np.repeat(rows, nx), np.repeat(rows, ny)]), np.concatenate([x, y])
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
            both = np.bincount(row[1:][twice], minlength=b.num_rows)
            mask = pa.array((both > 0) & (100 * both >= percent * (nx + ny - both)))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], schema=schema)
    return run


def _set_lister(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("values", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.pieces(batches, "text"):
            values, counts = shingle_sets(b.column(1), size)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), ts.list_array(values, counts, pa.int64())], schema=schema)
    return run


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity; ``texts`` (doc_id, text) has both sides."""
    full = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return full.mapInArrow(_verifier(size, percent), "a long, b long").distinct()


def _likely(pairs: DataFrame, cand: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose union sketch doesn't rule the similarity out; exact where it holds the whole union."""
    side = lambda i: cand.select(F.col("doc_id").alias(i), F.col("n_shingles").alias(f"n{i}"), F.col("sketch").alias(f"s{i}"))
    both = (pairs.join(side("a"), "a").join(side("b"), "b")
            .withColumn("all", F.array_union("sa", "sb")).withColumn("u", F.slice(F.array_sort("all"), 1, k))
            .withColumn("x", F.size(F.array_intersect("u", F.array_intersect("sa", "sb")))))
    whole = (F.col("na") <= k) & (F.col("nb") <= k) & (F.size("all") <= k)
    keep = F.when(whole, 100 * F.col("x") >= percent * F.size("u")).otherwise(F.col("x") >= least_shared(k, percent))
    return both.where(keep).select("a", "b")


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = K, size: int = SHINGLE,
                    percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |common shingles| >= ``percent`` * |all shingles| of their full sets;
    ``component_id`` is the smallest doc_id reachable over links, ``kept`` marks that document.

    * Null, empty and wordless texts have no shingles and link with nothing.
    * A null doc_id cannot be named in a link: such rows come back with a null component_id and kept = true.
    * Repeated rows come back as often as they stand; rows with one doc_id count as one document.
    * An empty table gives an empty result; other columns of ``docs``, whatever their names, are ignored.
    """
    st = Stage(spark, "near-duplicates")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sk = st.put("sketches", docs.mapInArrow(_sketcher(k, size), SKETCH_DDL))
    small = sk.select("doc_id", "n_shingles", "d1", "d2")
    named = small.where("doc_id IS NOT NULL AND n_shingles > 0")
    groups = st.put("groups", named.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep")))

    # first look: documents whose smallest values no other set holds have no partner
    look = (sk.where("doc_id IS NOT NULL").select("doc_id", "n_shingles", "d1", F.explode("look").alias("v"))
            .repartition("v"))  # one shuffle for both uses; a list has at most one of a document's values
    shared = look.groupBy("v").agg(F.min("d1").alias("x"), F.max("d1").alias("y")).where("x <> y").select("v")
    seen = (look.join(shared, "v").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.max("n_shingles").alias("n"))
            .where("c >= 2 OR n < 8").select("doc_id"))
    reps = groups.select(F.col("rep").alias("doc_id"))
    # a short set of its own has nothing in common with others unless a value is shared, which the lists test
    cand = st.put("candidates", only(sk.where("n_shingles > 0").select("doc_id", "n_shingles", "sketch"),
                                      st.put("seen", seen.join(reps, "doc_id", "left_semi"))))

    least = least_shared(k, percent)
    n = F.col("n_shingles")
    exact = F.ceil(n * percent / 100)
    bound = (F.when(n > k, F.lit(least))
             .when(F.floor(n * 100 / percent) > k, F.least(exact, k - (F.floor(n * 100 / percent) * (100 - percent) / 100).cast("long")))
             .otherwise(exact))
    entry = cand.select("doc_id", "n_shingles", F.explode("sketch").alias("v")).repartition("v")
    freq = entry.groupBy("v").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    rare = (entry.join(freq, "v").groupBy("doc_id", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("s"))
            .withColumn("take", (F.size("s") - bound + 1).cast("int"))  # unshared values come first in the order
            .where("take > 0"))
    lists = st.put("lists", rare.select("doc_id", "n_shingles", F.explode(F.slice("s", 1, F.col("take"))).alias("e"))
                   .select(F.col("e.v").alias("v"), "doc_id", F.col("n_shingles").alias("n")))
    known = docs.where("doc_id IS NOT NULL")
    near = "{0} * 100 >= {1} * %d AND {1} * 100 >= {0} * %d" % (percent, percent)

    # round 1: each member with the smallest and the largest document of its list
    ends = st.put("ends", lists.groupBy("v").agg(F.min(F.struct("doc_id", "n")).alias("lo"), F.max(F.struct("doc_id", "n")).alias("hi"))
                  .where("lo.doc_id < hi.doc_id"))
    stars = (lists.join(ends, "v")
             .select(F.struct("doc_id", "n").alias("me"), F.explode(F.array("lo", "hi")).alias("hub"))
             .where("me.doc_id <> hub.doc_id").where(near.format("me.n", "hub.n"))
             .select(F.least("me.doc_id", "hub.doc_id").alias("a"), F.greatest("me.doc_id", "hub.doc_id").alias("b")).distinct())
    stars = st.put("stars", stars)
    likely = st.put("likely", _likely(stars, cand, k, percent))
    ids = st.put("ids1", likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = st.put("texts1", only(known, ids))
    edges = st.put("edges1", _verified(likely, texts, size, percent))
    comp = st.put("comp1", connected_components(st, edges, "cc1"))
    st.drop("texts1", "ends", "likely")

    # round 2: whole sets of the documents in lists that hold several components
    placed = st.put("placed", lists.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                    .select("v", "doc_id", F.coalesce("component", "doc_id").alias("comp")))
    mixed = (placed.groupBy("v").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("v"))
    open_ = st.put("open", placed.join(mixed, "v").select("doc_id", "comp").distinct())
    texts = st.put("texts2", only(known, open_.select("doc_id")))
    full = st.put("sets", texts.mapInArrow(_set_lister(size), "doc_id long, n long, values array<long>"))
    entry = full.select("doc_id", "n", F.explode("values").alias("v")).repartition("v")
    freq = entry.groupBy("v").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    rare = (entry.join(freq, "v").groupBy("doc_id", "n").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("s"))
            .withColumn("take", (F.size("s") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")).where("take > 0"))
    members = (rare.select("doc_id", "n", (F.col("n") - F.size("s")).alias("alone"), F.posexplode(F.slice("s", 1, F.col("take"))).alias("i", "e"))
               .select(F.col("e.v").alias("v"), "doc_id", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("behind")))  # itself included
    members = st.put("members", members.join(open_, "doc_id"))
    sides = st.put("sides", members.groupBy("v", "comp").agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("behind").alias("r")))
    other = sides.select("v", F.col("comp").alias("comp2"), F.col("n0").alias("m0"), F.col("n1").alias("m1"), F.col("r").alias("q"))
    enough = "least({0}, {1}) * %d >= ({2} + {3}) * %d" % (100 + percent, percent)
    meet = (sides.join(other, "v").where("comp < comp2").where(enough.format("r", "q", "n0", "m0"))
            .where(f"n1 * 100 >= m0 * {percent} AND m1 * 100 >= n0 * {percent}").select("v", "comp", "comp2"))
    meet = st.put("meet", meet)
    one = members.select("v", "comp", F.col("doc_id").alias("p"), F.col("n").alias("np"), F.col("behind").alias("rp"))
    two = members.select("v", F.col("comp").alias("comp2"), F.col("doc_id").alias("q"), F.col("n").alias("nq"), F.col("behind").alias("rq"))
    rest = (meet.join(one, ["v", "comp"]).join(two, ["v", "comp2"])
            .where(near.format("np", "nq")).where(enough.format("rp", "rq", "np", "nq"))
            .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct().join(stars, ["a", "b"], "left_anti"))
    more = st.put("edges2", _verified(st.put("rest", rest), texts, size, percent))
    final = st.put("comp2", connected_components(st, edges.union(more), "cc2"))
    st.drop("lists", "candidates", "placed", "open", "texts2", "sets", "members", "sides", "meet", "rest", "stars")

    classes = st.put("classes", groups.join(final.withColumnRenamed("node", "rep"), "rep", "left")
                     .select("n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("component")))
    out = small.join(classes, ["n_shingles", "d1", "d2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
