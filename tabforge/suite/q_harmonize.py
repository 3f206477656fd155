"""Queries over the messy customer shards: S1 S3 S8 S10 H1-H11 I1-I3."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import inputs
from ..operators import harmonize as H
from ..plans.harmonize_folder import HarmonizeConfig, harmonize_folder
from .registry import query

def shard_of():
    return F.split_part(F.col("source_file"), F.lit("/"), F.lit(1))
OUT = ["customer_id", "first_name", "last_name", "nation_key", "account_balance", "segment", "notes"]


def harmonized(spark, sf_dir, index_mode="sequential"):
    root = inputs.customer_shards(spark, sf_dir)
    cfg = HarmonizeConfig(schema_map=inputs.SHARD_SCHEMA_MAP, index_mode=index_mode, types=["csv"])
    return harmonize_folder(spark, root, cfg)


@query("harmonize_customers", f"""
WITH {inputs.customer_shards_oracle()}
SELECT customer_id, first_name, last_name, nation_key, round(account_balance, 2) AS account_balance, segment, notes,
       shard, CAST(row_number() OVER (ORDER BY shard, customer_id) - 1 AS BIGINT) AS row_index
FROM shards""")
def harmonize_customers(spark, sf_dir):
    """Flagship: three header styles -> one typed, numbered table (H9 + I3)."""
    df = harmonized(spark, sf_dir).data
    return df.select(*OUT[:4], F.round("account_balance", 2).alias("account_balance"), *OUT[5:],
                     shard_of().alias("shard"), "row_index")


@query("index_local", f"""
WITH {inputs.customer_shards_oracle()}
SELECT customer_id, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY customer_id) - 1 AS BIGINT) AS row_index
FROM shards""")
def index_local(spark, sf_dir):
    """Numbering restarts in each file (one file per shard here)."""
    root = inputs.customer_shards(spark, sf_dir, files_per_shard=1)
    cfg = HarmonizeConfig(schema_map=inputs.SHARD_SCHEMA_MAP, index_mode="local", types=["csv"])
    df = harmonize_folder(spark, root, cfg).data
    return df.select("customer_id", shard_of().alias("shard"), "row_index")


@query("split_full_name", "SELECT p_partkey, CASE WHEN p_name IS NULL THEN NULL ELSE split_part(p_name, ' ', 1) END AS first_name, "
       "CASE WHEN instr(p_name, ' ') > 0 THEN substr(p_name, instr(p_name, ' ') + 1) END AS last_name FROM part")
def split_full_name(spark, sf_dir):
    """H3 on ``part.p_name``: split on the first space."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.col("p_name").alias("name"))
    return H.split_name(part)


ALIGN_TARGET = {"customer_id": "int64", "name": "object", "nation_key": "int64", "account_balance": "float64",
                "segment": "object"}


@query("align_reindex", "SELECT CAST(NULL AS BIGINT) AS customer_id, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation_key, "
       "s_acctbal AS account_balance, CAST(NULL AS VARCHAR) AS segment FROM supplier")
def align_reindex(spark, sf_dir):
    """H7: project a supplier slice to the customer layout (missing -> NULL, extras dropped)."""
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("nation_key"), F.col("s_acctbal").alias("account_balance"))
    return H.align_to_schema(sup, ALIGN_TARGET)


@query("union_sheets", "SELECT 'suppliers' AS sheet_name, s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation_key, "
       "CAST(NULL AS VARCHAR) AS market_segment FROM supplier UNION ALL SELECT 'customers', c_custkey, c_name, "
       "CAST(c_nationkey AS BIGINT), c_mktsegment FROM customer")
def union_sheets(spark, sf_dir):
    """H8: two differently shaped 'sheets', each normalised, tagged and unioned (types merged first)."""
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").alias("ID"), F.col("s_name").alias("Name"), F.col("s_nationkey").alias("Nation Key"))
    cus = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("NAME"), F.col("c_nationkey").cast("bigint").alias("nation key"),
        F.col("c_mktsegment").alias("Market Segment"))
    out = H.union_sheets({"suppliers": sup, "customers": cus}, split_names=False)
    return out.select("sheet_name", "id", "name", F.col("nation_key").cast("bigint").alias("nation_key"), "market_segment")
