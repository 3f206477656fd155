"""Contiguous shards of near-equal byte size (operator 2).

Documents stand in doc_id order. Global prefix sums of their sizes come from per-partition totals, and the whole
length is cut at equal targets: a document goes to the shard in which its middle byte falls, so every cut is within
half a document of its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .prefix import running_sums
from .stage import Stage, text_or_empty


def document_size(text: str = "text"):
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.octet_length(text_or_empty(text)) + 1).cast("long")


def _cut(before: str, size: str, total, shards: int):
    return F.expr(f"(2 * {before} + {size}) * {shards} div (2 * {total})").cast("int")


def shard_assignments(spark: SparkSession, docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, shard (0 to shards-1), slot (gapless from 0).

    Null and empty texts have size 1 and the CRC of no bytes, 0. Null doc_ids come first; rows with one doc_id stand
    in order of CRC and size, so repeated rows are neighbours. A document larger than a target leaves shards without
    rows rather than being split. An empty table gives an empty result; other columns are ignored.
    """
    st = Stage(spark, "shards")
    base = st.put("sizes", docs.select(F.col("doc_id").cast("long").alias("doc_id"), document_size().alias("size"),
                                       F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32")))
    placed, sums = running_sums(st, base, ["doc_id", "text_crc32", "size"], "size")
    total = sums.first()["sum"] or 1
    placed = placed.withColumn("shard", _cut("before", "size", total, shards))
    first = placed.groupBy("shard").agg(F.min("row").alias("_first"))
    return (placed.join(F.broadcast(first), "shard")  # at most `shards` rows
            .select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("_first")).alias("slot")))


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 16) -> DataFrame:
    """``docs`` with all its columns and ``_shard`` (int), cut as in :func:`shard_assignments`.

    Only the order and the sizes are shuffled; texts stay where they are. The cuts between shards are at most
    ``shards - 1`` places in the order (doc_id, CRC, size), and each row compares itself with them. Rows that agree
    in all three stay together, in the last of the shards that hold one of them.
    """
    key = ["doc_id", "text_crc32", "size"]
    cuts = (shard_assignments(spark, docs, shards).groupBy("shard")
            .agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), *key)).alias("c")).orderBy("shard").collect())
    out = F.lit(0)
    mine = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").cast("long").alias("doc_id"),
                    F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"), document_size().alias("size"))
    for row in cuts:  # one for each shard
        c = row["c"]
        low = F.struct(F.lit(c["known"]).alias("known"), F.lit(c["doc_id"]).cast("long").alias("doc_id"),
                       F.lit(c["text_crc32"]).cast("long").alias("text_crc32"), F.lit(c["size"]).cast("long").alias("size"))
        out = F.when(mine >= low, F.lit(row["shard"])).otherwise(out)
    return docs.withColumn("_shard", out.cast("int"))
