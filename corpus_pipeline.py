"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, mixing to target weights, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's ``docs``. All stages but the last return the columns of ``documents``. SQL cannot express the first two stages,
so ``ORACLE_SQL`` is None and the tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import decontam, minhash, sharding, toxicity
from tabforge.llm.queries import mix_documents
from tabforge.llm.stage import Stage, only

SHARDS = 16
#: Words that the mixing stage may take, in percent of those it gets; each document at most once.
MIX_PERCENT = 90


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under the threshold. The field is fitted on the labelled ones among ``docs``."""
    model = toxicity.train(spark, docs, _table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


#: Keys that stand for rows without a doc_id of their own begin here.
OWN_KEYS = 1 << 62


def _keyed(stage: Stage, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key for every row, and the key's name: the doc_id where no other row has it, else (and where it is
    null or as large as these keys) a 62-bit hash of doc_id and text behind all doc_ids. Only equal rows share a key."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    number = F.col("doc_id").cast("long")
    clash = stage.put("clashes", docs.where("doc_id IS NOT NULL").groupBy(number.alias(name)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name))
    own = (F.xxhash64(F.col("doc_id"), F.col("text"), F.col("doc_id").isNull()).bitwiseAND(F.lit(OWN_KEYS - 1)) + F.lit(OWN_KEYS)).alias(name)
    rows = docs.withColumn(name, F.when(number < OWN_KEYS, number))
    if clash.isEmpty():
        return rows.withColumn(name, F.coalesce(name, own)), name
    once = only(rows.where(F.col(name).isNotNull()), clash, name, "left_anti")
    many = only(rows.where(F.col(name).isNotNull()), clash, name).unionByName(rows.where(F.col(name).isNull()))
    return once.unionByName(many.withColumn(name, own)), name


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, that of the smallest doc_id (rows without a doc_id of their own come last); of rows
    equal in doc_id and text one stays. Rows without words stay."""
    stage = Stage(spark, "pipeline-copies")
    keyed, key = _keyed(stage, docs)
    found = minhash.near_duplicates(spark, keyed.select(F.col(key).alias("doc_id"), "text"))
    found = stage.put("classes", found.select(F.col("doc_id").alias(key), "kept"))
    rest = only(keyed, stage.put("gone", found.where("NOT kept").select(key).distinct()), key, "left_anti")
    many = stage.put("repeated", found.where(F.col(key) >= OWN_KEYS).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key))
    if many.isEmpty():
        return rest.select(*docs.columns)
    once = only(rest, many, key).dropDuplicates([key])
    return only(rest, many, key, "left_anti").unionByName(once).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item of a window's words or more is found; shorter items stand in clean texts too."""
    stage = Stage(spark, "pipeline-leaks")
    keyed, key = _keyed(stage, docs)
    found = decontam.contaminated(spark, keyed.select(F.col(key).alias("doc_id"), "text"), _table(spark, sf_dir, "benchmark"))
    found = found.where(F.col("item_words") >= decontam.WINDOW).select(F.col("doc_id").alias(key)).distinct()
    return only(keyed, stage.put("found", found), key, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each domain, language and source up to its token budget, without repetition."""
    return mix_documents(spark, docs, MIX_PERCENT, 1).select(*docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their contiguous shard of near-equal bytes."""
    out = sharding.shard_documents(spark, docs, SHARDS)
    return out.select(*docs.columns, F.col("_shard").alias("shard")) if "shard" not in docs.columns else out


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    stage = Stage(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = stage.put(name, step(spark, docs, sf_dir))
        if i > 1:
            stage.drop(STAGES[i - 2][0])
    return docs
