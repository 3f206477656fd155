"""Phrase collocations by set-oriented relational mining (operator 12).

Every word occurrence is a row of a relation, sorted by document and position; the place of a separator between two
pieces is left out, so neighbouring positions always belong to one piece. Relations are written, and the next length
comes from a merge join:

1. Words are counted per language. Those that occur often enough get a number; the occurrences of the others can't be
   in a frequent phrase and are left out (semi-join).
2. R2: occurrences joined with themselves on document and the next position, grouped and counted; the same join with
   the frequent pairs (semi-join) gives the relation, under the pair's number. Joining twice in the order of the rows
   costs less than writing the occurrences of all pairs.
3. R(k+1): neighbouring occurrences of R(k), which overlap in k-1 words, joined in the same way, and so on.

Relations are bucketed and sorted by document in the shared folder, so the merge joins take both sides as they lie,
without a shuffle, and a word or phrase that is everywhere is spread over all documents. Counts are combined before
they are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .prefix import running_sums
from .stage import Stage, parts_for, text_or_empty

MIN_COUNT = 10
TOP = 2000
#: A shorter phrase is dropped if a longer one that holds it has so many percent of its occurrences.
SWALLOW_PERCENT = 50
#: Rows up to which the table of frequent words (strings), and of frequent phrases (three longs), is sent to every executor.
BROADCAST_WORDS, BROADCAST_PHRASES = 1_000_000, 1_500_000
#: Bytes of text a bucket holds.
BUCKET_BYTES = 12 << 20

# fixed values: what ends a piece
SEPARATORS = ".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"[^ \t.,;:!?\n\x0B\f\r]+|[.,;:!?\n\x0B\f\r]"


def tokens_of(text: Column) -> Column:
    """Words as they stand and separators, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    names = {n.replace("_", "."): v for n, v in values.items()}
    old = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        yield
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)


def _planned(spark: SparkSession):
    """Joins on document and position use rows as they lie by document, in their order where a bucket is one file; a write
    deletes the shuffle files it has read."""
    return _settings(spark, spark_sql_requireAllClusterKeysForCoPartition="false", spark_sql_legacy_bucketedTableScan_outputOrdering="true",
                     spark_sql_classic_shuffleDependency_fileCleanup_enabled="true")


class Relations:
    """Sorted occurrence relations: bucketed tables in the stage's folder, known to the session under names of their own."""

    def __init__(self, stage: Stage, buckets: int):
        self.stage, self.buckets, self.names = stage, buckets, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        (df.write.format("parquet").option("path", self.stage.path(name)).bucketBy(self.buckets, "doc").sortBy("doc", "pos").saveAsTable(table))
        self.names[name] = table
        return self.stage.spark.table(table)

    def forget(self, *names: str) -> None:
        for n in names:
            self.stage.spark.sql(f"DROP TABLE {self.names.pop(n)}")
            self.stage.drop(n)


def _numbered(st: Stage, name: str, counts: DataFrame) -> DataFrame:
    """``counts`` with numbers without gaps, the most frequent first: small numbers for what is written most often."""
    ranked, _ = running_sums(st, st.put(f"{name}-counts", counts.withColumn("rare", -F.col("a"))), ["rare"], "a", name=f"{name}-order")
    kind = "int" if ranked.count() < 1 << 31 else "long"  # two ints make one key of a hashed relation
    return st.put(name, ranked.select(*counts.columns, F.col("row").cast(kind).alias("id")))


def _known(table: DataFrame, most: int) -> tuple[DataFrame, bool]:
    small = table.count() <= most
    return (F.broadcast(table) if small else table), small


def mine(spark: SparkSession, docs: DataFrame, longest: int = 3, min_count: int = MIN_COUNT) -> DataFrame:
    """docs (text, lang) -> a row for each phrase of 2 to ``longest`` words that occurs ``min_count`` times or more in a
    language: lang, words (array), a (its occurrences), heads and tails (arrays: occurrences of its first and last 1, 2,
    ... words), longer (most occurrences of a frequent phrase with one word more that holds it, or null), n (all words
    of the language).

    Null texts are empty, a null language is ``und``. Every row counts, repeated ones too. Empty texts and tables give
    no phrases; other columns are ignored. A text without separators is one piece, however long.
    """
    with _planned(spark):
        return _mine(spark, docs, longest, min_count)


def _mine(spark: SparkSession, docs: DataFrame, longest: int, min_count: int) -> DataFrame:
    st = Stage(spark, "collocations")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rel = Relations(st, parts_for(spark, size, BUCKET_BYTES))
    raw = rows.select("lang", F.explode(tokens_of(F.col("text"))).alias("raw")).groupBy("lang", "raw").agg(F.count(F.lit(1)).alias("a"))
    raw = st.put("raw", raw.where(~F.col("raw").isin(*SEPARATORS)).withColumn("word", F.translate("raw", UPPER, LOWER)))
    counts = st.put("words", raw.groupBy("lang", "word").agg(F.sum("a").alias("a")))
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    known = _numbered(st, "known", counts.where(F.col("a") >= min_count))

    # R1, with documents under a number of their own
    names, small = _known(st.put("names", raw.join(known, ["lang", "word"]).select("lang", "raw", "id")), BROADCAST_WORDS)
    placed = rows.select(F.monotonically_increasing_id().alias("doc"), "lang", "text").repartition(rel.buckets, "doc").sortWithinPartitions("doc")
    r = (placed.select("doc", "lang", F.posexplode(tokens_of(F.col("text"))).alias("pos", "raw"))
         .where((F.length("raw") > 1) | (F.instr(F.lit(SEPARATORS), F.col("raw")) == 0))
         .join(names, ["lang", "raw"]).select("doc", "pos", "id"))
    r = rel.put("r1", r if small else r.repartition(rel.buckets, "doc"))
    level = known.select("id", "lang", F.array("word").alias("words"), "a", F.array().cast("array<long>").alias("heads"), F.array().cast("array<long>").alias("tails"))
    found = []
    for k in range(2, longest + 1):
        nxt = r.select("doc", (F.col("pos") - 1).alias("pos"), F.col("id").alias("right"))
        pairs = r.withColumnRenamed("id", "left").hint("merge").join(nxt, ["doc", "pos"])
        often = pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("a")).where(F.col("a") >= min_count)
        # phrases of the last length are no part of others and need no number
        often = _numbered(st, f"often{k}", often) if k < longest else st.put(f"often{k}", often.withColumn("id", F.lit(None).cast("long")))
        if k < longest:
            keys, small = _known(often.select("left", "right", "id"), BROADCAST_PHRASES)
            kept = pairs.join(keys, ["left", "right"]).select("doc", "pos", "id")
            r = rel.put(f"r{k}", kept if small else kept.repartition(rel.buckets, "doc"))
            rel.forget(f"r{k - 1}")
        first, last = level.alias("x"), level.alias("y")
        grown = (often.alias("p").join(first, F.col("p.left") == F.col("x.id")).join(last, F.col("p.right") == F.col("y.id"))
                 .select("p.id", "x.lang", F.concat("x.words", F.slice("y.words", -1, 1)).alias("words"), "p.a", "p.left", "p.right",
                         F.concat("x.heads", F.array("x.a")).alias("heads"), F.concat("y.tails", F.array("y.a")).alias("tails")))
        grown = st.put(f"level{k}", grown)
        if k > 2:
            inside = grown.select(F.col("left").alias("id"), "a").unionByName(grown.select(F.col("right").alias("id"), "a"))
            found[-1] = found[-1].join(inside.groupBy("id").agg(F.max("a").alias("longer")), "id", "left")
        found.append(grown)
        level = grown
    rel.forget(*rel.names)
    found[-1] = found[-1].withColumn("longer", F.lit(None).cast("long"))
    whole = found[0]
    for f in found[1:]:
        whole = whole.unionByName(f, allowMissingColumns=True)
    return whole.join(totals, "lang").select("lang", "words", "a", "heads", "tails", "longer", "n")


def top_collocations(spark: SparkSession, docs: DataFrame, longest: int = 3, min_count: int = MIN_COUNT,
                     swallow_percent: int = SWALLOW_PERCENT, top: int = TOP) -> DataFrame:
    """The best ``top`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A cut of a phrase gives l occurrences of what stands before it, r of what stands behind, and the score
    1,000,000 a a / (l r), rounded down; the cut of the lowest score counts, the first of equal ones. Phrases with
    ``swallow_percent`` of their occurrences inside one longer phrase are dropped. Ties in the score are settled by a,
    then by the phrase's bytes.

    Rows, nulls and empty texts count as in :func:`mine`. Numbers are exact up to 38 digits of 1,000,000 a a and l r.
    """
    found = mine(spark, docs, longest, min_count)
    kept = found.where(F.col("longer").isNull() | (100 * F.col("longer") < swallow_percent * F.col("a")))
    big = "CAST({} AS DECIMAL(19, 0))"
    score = f"CAST((1000000 * ({big.format('a')} * {big.format('a')})) div ({big.format('get(heads, k)')} * {big.format('get(tails, size(words) - 2 - k)')}) AS BIGINT)"
    cuts = f"transform(sequence(0, size(words) - 2), k -> named_struct('score', {score}, 'k', k, 'l', get(heads, k), 'r', get(tails, size(words) - 2 - k)))"
    scored = (kept.withColumn("cut", F.expr(f"array_min({cuts})"))
              .select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
