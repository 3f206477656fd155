"""Source and sink queries: S1, S5-S7, S10, S11, H4, H10, K1, K2."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import inputs
from ..operators import harmonize as H
from ..plans.harmonize_folder import HarmonizeConfig, check_inputs, detect_schema, harmonize_folder
from ..session import staging_path
from ..sources.catalog import file_catalog
from ..sources.jsonsrc import flatten_one_level
from ..sources.sinks import write_table
from ..streaming.ingest import ingest_folder, ingest_stream, read_ingested
from .registry import query

def shard_of():
    return F.split_part(F.col("source_file"), F.lit("/"), F.lit(1))


@query("catalog_scan", "SELECT shard, CAST(2 AS BIGINT) AS files, '.csv' AS extension FROM "
       "(VALUES ('style_a'), ('style_b'), ('style_c')) t(shard)")
def catalog_scan(spark, sf_dir):
    """List the written shard folder (recursive, csv only, case-insensitive)."""
    root = inputs.customer_shards(spark, sf_dir)
    cat = file_catalog(spark, root, recursive=True, types=["CSV"])
    shard = F.regexp_extract("parent", r"([^/]+)$", 1)
    return cat.groupBy(shard.alias("shard"), "extension").agg(F.count(F.lit(1)).cast("bigint").alias("files"))


def _part_json(spark, sf_dir):
    """`part` as array-root JSON files of at most 1000 records, with a nested object per record."""
    root = staging_path(spark, "part-json")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    rec = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                   F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
                            F.col("p_size").alias("size")).alias("details"),
                   F.col("p_retailprice").alias("price"))
    docs = (part.groupBy(F.floor(F.col("p_partkey") / 1000).alias("bucket"))
                .agg(F.to_json(F.sort_array(F.collect_list(rec))).alias("value")))
    docs.write.mode("overwrite").partitionBy("bucket").text(root)
    inputs.set_extension(spark, root, ".json")
    return root


@query("json_array_root", "SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_type AS type, "
       "CAST(p_size AS BIGINT) AS size, p_retailprice AS price FROM part")
def json_array_root(spark, sf_dir):
    """S5 + S7: array-root files, nested ``details`` lifted one level."""
    root = _part_json(spark, sf_dir)
    cfg = HarmonizeConfig(types=["json"], index_mode="none", split_names=False)
    df = harmonize_folder(spark, root, cfg).data
    return df.select("id", "name", "brand", "type", "size", F.round("price", 2).alias("price"))


def _supplier_json(spark, sf_dir):
    root = staging_path(spark, "supplier-json")
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    docs = (sup.groupBy(F.floor(F.col("s_suppkey") / 1000).alias("bucket"))
               .agg(F.to_json(F.struct(
                   F.sort_array(F.collect_list(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))))
                   .alias("suppliers"),
                   F.sort_array(F.collect_list(F.struct(F.col("s_suppkey").alias("id"),
                                                        F.col("s_acctbal").alias("balance")))).alias("balances"),
                   F.lit("generated").alias("meta"))).alias("value")))
    docs.write.mode("overwrite").partitionBy("bucket").text(root)
    inputs.set_extension(spark, root, ".json")
    return root


@query("json_object_root", "SELECT 'suppliers' AS sheet_name, s_suppkey AS id, s_name AS name, CAST(NULL AS DOUBLE) AS balance "
       "FROM supplier UNION ALL SELECT 'balances', s_suppkey, NULL, s_acctbal FROM supplier")
def json_object_root(spark, sf_dir):
    """Every array-valued key is a sheet tagged in ``sheet_name``; the scalar key is ignored."""
    root = _supplier_json(spark, sf_dir)
    cfg = HarmonizeConfig(types=["json"], index_mode="none", split_names=False, json_object_root=True)
    df = harmonize_folder(spark, root, cfg).data
    return df.select("sheet_name", "id", "name", F.round("balance", 2).alias("balance"))


def _with_bad_file(spark, sf_dir):
    """Fresh shards plus one CSV whose last data line has more fields than the header."""
    root = inputs.customer_shards(spark, sf_dir, fresh=True)
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").filter(F.col("c_nationkey") == 0)
    lines = cust.select(F.col("c_custkey").alias("k"), F.concat_ws(",", F.col("c_custkey").cast("string"),
                        F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_name")), F.col("c_nationkey").cast("string"),
                        F.col("c_acctbal").cast("string")).alias("value"))
    ranked = lines.withColumn("value", F.when(
        F.col("k") == lines.agg(F.max("k")).first()[0], F.concat(F.col("value"), F.lit(",extra,fields"))
    ).otherwise(F.col("value")))
    header = spark.createDataFrame([(-1, "Customer ID,Full Name,Nation Key,Account Balance")], "k BIGINT, value STRING")
    header.unionByName(ranked).orderBy("k").select("value").coalesce(1).write.mode("overwrite").text(f"{root}/bad")
    inputs.set_extension(spark, f"{root}/bad", ".csv")
    return root


@query("bad_files_skipped", f"WITH {inputs.customer_shards_oracle()} "
       "SELECT shard, count(*) AS n, CAST(sum(customer_id) AS BIGINT) AS key_sum FROM shards GROUP BY shard")
def bad_files_skipped(spark, sf_dir):
    """The file with a long row is dropped whole; all other files load."""
    root = _with_bad_file(spark, sf_dir)
    cfg = HarmonizeConfig(schema_map=inputs.SHARD_SCHEMA_MAP, index_mode="none", types=["csv"])
    df = harmonize_folder(spark, root, cfg).data
    return df.groupBy(shard_of().alias("shard")).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                                F.sum("customer_id").cast("bigint").alias("key_sum"))


@query("file_status", "SELECT shard, CASE WHEN shard = 'bad' THEN 'failed' ELSE 'ok' END AS status, CAST(n AS BIGINT) AS rows, "
       "CAST(files AS BIGINT) AS files FROM (SELECT 'style_a' AS shard, count(*) AS n, 2 AS files FROM customer WHERE c_nationkey < 8 "
       "UNION ALL SELECT 'style_b', count(*), 2 FROM customer WHERE c_nationkey >= 8 AND c_nationkey < 16 "
       "UNION ALL SELECT 'style_c', count(*), 2 FROM customer WHERE c_nationkey >= 16 "
       "UNION ALL SELECT 'bad', 0, 1) t")
def file_status(spark, sf_dir):
    """Per-file status table (failed files report 0 rows)."""
    root = _with_bad_file(spark, sf_dir)
    cfg = HarmonizeConfig(schema_map=inputs.SHARD_SCHEMA_MAP, index_mode="none", types=["csv"])
    st = harmonize_folder(spark, root, cfg).file_status
    return st.groupBy(shard_of().alias("shard"), "status").agg(F.sum("rows").cast("bigint").alias("rows"),
                                                          F.count(F.lit(1)).cast("bigint").alias("files"))


@query("detect_schema_types", "SELECT * FROM (VALUES (0, 'customer_id', 'int64'), (1, 'first_name', 'object'), "
       "(2, 'last_name', 'object'), (3, 'nation_key', 'int64'), (4, 'account_balance', 'float64'), "
       "(5, 'segment', 'object'), (6, 'notes', 'object'), (7, 'source_file', 'object')) t(position, column_name, dtype)")
def detect_schema_types(spark, sf_dir):
    """H4/H5: merged column types across the three header styles."""
    root = inputs.customer_shards(spark, sf_dir)
    cfg = HarmonizeConfig(schema_map=inputs.SHARD_SCHEMA_MAP, types=["csv"])
    return detect_schema(spark, root, cfg)


@query("run_stats", "SELECT CAST(6 AS BIGINT) AS files_processed, count(*) AS total_rows, CAST(9 AS BIGINT) AS total_columns "
       "FROM customer")
def run_stats(spark, sf_dir):
    """Files, rows and columns of a harmonised run."""
    root = inputs.customer_shards(spark, sf_dir)
    cfg = HarmonizeConfig(schema_map=inputs.SHARD_SCHEMA_MAP, types=["csv"])
    return H.run_stats(harmonize_folder(spark, root, cfg).data)


_BROKEN_NAME = "c_name || chr(10) || chr(10) || 'known as \"' || c_mktsegment || '\",' || chr(10) || 'since ' || c_nationkey"


@query("csv_multiline", f"SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN {_BROKEN_NAME} ELSE c_name END AS label, "
       "c_acctbal AS balance, CASE WHEN c_custkey % 2 = 0 THEN 'a \"b' END AS note FROM customer")
def csv_multiline(spark, sf_dir):
    """S3: quoted fields with line breaks, blank lines, quotes and separators; one file has a field that never ends."""
    root = staging_path(spark, "multiline")
    broken = F.concat(F.col("c_name"), F.lit('\n\nknown as "'), F.col("c_mktsegment"), F.lit('",\nsince '), F.col("c_nationkey").cast("string"))
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("ID"), F.when(F.col("c_custkey") % 3 == 0, broken).otherwise(F.col("c_name")).alias("Label"),
        F.col("c_acctbal").alias("Balance"), F.when(F.col("c_custkey") % 2 == 0, 'a "b').alias("Note"))
    cust.write.option("header", "true").csv(f"{root}/good")
    spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.lit('ID,Label\n1,"never\nends').alias("value")).limit(1).write.text(f"{root}/bad")
    inputs.set_extension(spark, f"{root}/bad", ".csv")
    df = harmonize_folder(spark, root, HarmonizeConfig(index_mode="none", split_names=False, types=["csv"])).data
    return df.select("id", "label", "balance", "note")


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf_dir):
    """K1 then S3: write ``customer`` as CSV part files with headers, harmonise it back."""
    path, cols = staging_path(spark, "customer-csv"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    write_table(spark.read.parquet(f"{sf_dir}/customer.parquet").select(*cols), path, "csv")
    cfg = HarmonizeConfig(types=["csv"], index_mode="none", split_names=False)
    return harmonize_folder(spark, path, cfg).data.select(*cols)


@query("json_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def json_roundtrip(spark, sf_dir):
    """K2: write ``orders`` as JSON lines and read it back."""
    path, kind = staging_path(spark, "orders-json"), "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE"
    write_table(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice"), path, "json")
    return spark.read.schema(kind).json(path)


INGEST_TYPES = {"customer_id": "int64", "first_name": "object", "last_name": "object", "nation_key": "int64", "account_balance": "float64",
                "segment": "object", "notes": "object"}


@query("incremental_ingest", f"WITH {inputs.customer_shards_oracle()}, f AS (SELECT * FROM shards UNION ALL "
       "SELECT 'late', n_nationkey + 5000000, 'Late', n_name, n_nationkey, NULL, NULL, NULL FROM nation) "
       "SELECT shard, customer_id, first_name, last_name, nation_key, account_balance, segment, notes FROM f")
def incremental_ingest(spark, sf_dir):
    """All shards with their three headers, then a second run that takes up one more folder only."""
    root = inputs.customer_shards(spark, sf_dir, fresh=True)
    sink, ckpt = staging_path(spark, "ingest-out"), staging_path(spark, "ingest-ckpt")
    cfg = HarmonizeConfig(schema_map=inputs.SHARD_SCHEMA_MAP)
    ingest_stream(spark, root, sink, ckpt, INGEST_TYPES, cfg)
    late = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.concat(F.lit("Late "), "n_name").alias("Full Name"), (F.col("n_nationkey") + 5000000).alias("cust_id"), F.col("n_nationkey").alias("NATION"))
    late.write.option("header", "true").csv(f"{root}/late")
    ingest_stream(spark, root, sink, ckpt, INGEST_TYPES, cfg)
    out = spark.read.parquet(f"{sink}/data")
    return out.select(shard_of().alias("shard"), *list(INGEST_TYPES)[:4], F.round("account_balance", 2).alias("account_balance"), "segment", "notes")


@query("ingest_mixed", """SELECT 'csv' AS kind, c_custkey AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS code, CAST(NULL AS DOUBLE) AS balance FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT 'json', c_custkey, c_name, CAST(c_nationkey AS VARCHAR), c_acctbal FROM customer WHERE c_custkey % 3 = 1
UNION ALL SELECT 'late', c_custkey, NULL, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 = 2
UNION ALL SELECT 'book', n_nationkey + 7000000, n_name, CAST(n_nationkey AS VARCHAR), NULL FROM nation""")
def ingest_mixed(spark, sf_dir):
    """S11 with I2: CSV and a workbook in the first run, JSON in the second, which adds a column and makes another one text."""
    root, sink, ckpt = (staging_path(spark, f"ingest-{n}") for n in ("in", "all", "all-ckpt"))
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    cfg = HarmonizeConfig(split_names=False)
    cust.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("Name"), F.col("c_nationkey").alias("Code")).write.option("header", "true").csv(f"{root}/csv")
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey") + 7000000, "n_name", "n_nationkey").collect()
    inputs.write_workbook(spark, f"{root}/book/nations.xlsx", {"First": [["Id", "Name", "Code"], *map(list, rows)]})
    ingest_folder(spark, root, sink, ckpt, cfg)
    for kind, k, rec in (("json", 1, F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("code"), F.col("c_acctbal").alias("balance"))),
                         ("late", 2, F.struct(F.col("c_custkey").alias("ID"), F.col("c_mktsegment").alias("CODE"), F.col("c_acctbal").alias("Balance")))):
        docs = inputs.by_bucket(cust.where(F.col("c_custkey") % 3 == k), "c_custkey").groupBy("b").agg(F.to_json(F.collect_list(rec)).alias("value"))
        inputs.write_documents(docs, f"{root}/{kind}")
    ingest_folder(spark, root, sink, ckpt, cfg)
    return read_ingested(spark, sink).select(shard_of().alias("kind"), "id", "name", "code", F.round("balance", 2).alias("balance"))


MIXED_MAP = {"customer_id": ["Customer ID", "id"], "name": ["Full Name"], "nation_key": ["Nation Key", "nation"]}


def _mixed(spark, sf_dir):
    """A folder of CSV (quoted separators), JSON of both roots, a workbook, truncated JSON and a CSV with a long row."""
    root = staging_path(spark, "mixed")
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    name = F.concat("c_mktsegment", F.lit(", the "), "c_name")
    csv_part = cust.where("c_nationkey < 8").select(F.col("c_custkey").alias("Customer ID"), name.alias("Full Name"), F.col("c_nationkey").alias("Nation Key"))
    csv_part.write.option("header", "true").csv(f"{root}/csv")
    rec = F.struct(F.col("c_custkey").alias("id"), F.concat_ws(" ", "c_mktsegment", "c_name").alias("name"), F.struct(F.col("c_nationkey").alias("nation")).alias("at"))
    of_bucket = lambda cond: inputs.by_bucket(cust.where(cond), "c_custkey").groupBy("b")
    inputs.write_documents(of_bucket("c_nationkey BETWEEN 8 AND 11").agg(F.to_json(F.collect_list(rec)).alias("value")), f"{root}/array")
    south = F.col("c_nationkey") % 2 == 0
    objects = of_bucket("c_nationkey BETWEEN 12 AND 15").agg(F.to_json(F.struct(
        F.collect_list(F.when(south, rec)).alias("south"), F.collect_list(F.when(~south, rec)).alias("north"), F.lit("m").alias("meta"))).alias("value"))
    inputs.write_documents(objects, f"{root}/object")
    cut = of_bucket("c_nationkey = 16").agg(F.to_json(F.collect_list(rec)).alias("value"))
    inputs.write_documents(cut.select(F.expr("substring(value, 1, length(value) - 9)").alias("value")), f"{root}/cut")
    long = cust.where("c_nationkey = 17").select(F.concat_ws(",", "c_custkey", "c_name", F.lit("17"), F.lit("x")).alias("value"), F.col("c_custkey").alias("k"))
    head = spark.createDataFrame([("Customer ID,Full Name,Nation Key", -1)], "value STRING, k BIGINT")
    head.unionByName(long).repartition(1).sortWithinPartitions("k").select("value").write.text(f"{root}/long")  # one malformed file
    inputs.set_extension(spark, f"{root}/long", ".csv")
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey") + 7000000, F.concat(F.lit("Nation "), "n_name"), "n_nationkey").collect()
    inputs.write_workbook(spark, f"{root}/book/nations.xlsx", {"First": [["Customer ID", "Full Name", "Nation Key"], *map(list, rows)], "Other": [["x"], [1]]})
    return root


@query("harmonize_mixed", """SELECT 'csv' AS kind, c_custkey AS customer_id, c_mktsegment || ',' AS first_name, 'the ' || c_name AS last_name,
  CAST(c_nationkey AS BIGINT) AS nation_key, CAST(NULL AS VARCHAR) AS sheet_name FROM customer WHERE c_nationkey < 8
UNION ALL SELECT 'array', c_custkey, split_part(c_mktsegment || ' ' || c_name, ' ', 1),
  substr(c_mktsegment || ' ' || c_name, instr(c_mktsegment || ' ' || c_name, ' ') + 1), c_nationkey, NULL FROM customer WHERE c_nationkey BETWEEN 8 AND 11
UNION ALL SELECT 'object', c_custkey, split_part(c_mktsegment || ' ' || c_name, ' ', 1),
  substr(c_mktsegment || ' ' || c_name, instr(c_mktsegment || ' ' || c_name, ' ') + 1), c_nationkey,
  CASE WHEN c_nationkey % 2 = 0 THEN 'south' ELSE 'north' END FROM customer WHERE c_nationkey BETWEEN 12 AND 15
UNION ALL SELECT 'book', n_nationkey + 7000000, 'Nation', n_name, n_nationkey, 'First' FROM nation""")
def harmonize_mixed(spark, sf_dir):
    """Every format and both failures in one folder, all parsed once."""
    df = harmonize_folder(spark, _mixed(spark, sf_dir), HarmonizeConfig(schema_map=MIXED_MAP, index_mode="none")).data
    return df.select(shard_of().alias("kind"), *[F.col(c) for c in ("customer_id", "first_name", "last_name", "nation_key", "sheet_name")])


@query("json_mixed_keys", """SELECT 'upper' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS bal, CAST(NULL AS VARCHAR) AS sheet_name FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT 'lower', c_custkey, c_name, NULL, NULL FROM customer WHERE c_custkey % 4 = 1
UNION ALL SELECT 'sheet', c_custkey, c_mktsegment, NULL, 'part' FROM customer WHERE c_custkey % 4 = 2""")
def json_mixed_keys(spark, sf_dir):
    """Keys in other case, a key that is an array in one file and a scalar in another, empty arrays and documents."""
    root = staging_path(spark, "json-keys")
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    one = inputs.by_bucket(cust, "c_custkey").groupBy("b")
    upper, lower = F.struct(F.col("c_custkey").alias("ID"), F.col("c_name").alias("Name"), F.struct(F.col("c_acctbal").alias("Bal")).alias("at")), F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    pick = lambda k, e: F.collect_list(F.when(F.col("c_custkey") % 4 == k, e))
    docs = {"upper": F.to_json(pick(0, upper)), "lower": F.to_json(pick(1, lower)),
            "sheet": F.to_json(F.struct(pick(2, F.struct(F.col("c_custkey").alias("Id"), F.col("c_mktsegment").alias("NAME"))).alias("part"), F.lit("x").alias("other"))),
            "scalar": F.to_json(F.struct(F.max("c_name").alias("part"), F.array().cast("array<int>").alias("other"))), "empty": F.lit("[]"), "blank": F.lit("")}
    for kind, doc in docs.items():
        inputs.write_documents(one.agg(doc.alias("value")), f"{root}/{kind}")
    df = harmonize_folder(spark, root, HarmonizeConfig(types=["json"], index_mode="none", split_names=False)).data
    return df.select(shard_of().alias("kind"), "id", "name", F.round("bal", 2).alias("bal"), "sheet_name")


@query("json_flatten", "SELECT p_partkey AS id, p_brand AS brand, p_type AS name, '{\"s\":' || CAST(p_size AS VARCHAR) || '}' AS deep FROM part")
def json_flatten(spark, sf_dir):
    """S7 on a table: object fields lifted one level, a later name replaces an earlier one, deeper objects stay JSON text."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("name"), F.struct(F.col("p_size").alias("s")).alias("deep")).alias("details"))
    return flatten_one_level(part)


@query("input_checks", "SELECT CASE WHEN k = 0 THEN 'error' ELSE 'warning' END AS severity, CASE WHEN k = 0 THEN "
       "'no processable files (xlsx)' ELSE CAST(n AS VARCHAR) || ' empty files will be skipped' END AS message "
       "FROM (SELECT count(*) FILTER (WHERE o_orderkey % 5 = 0) AS n FROM orders), range(2) t(k)")
def input_checks(spark, sf_dir):
    """H11 over a catalog: no file of the wanted type, and some empty ones."""
    cat = inputs.catalog(spark, sf_dir).withColumn("size", F.when(F.col("file_id") % 5 == 0, 0).otherwise(F.col("size")))
    return check_inputs(spark, cat.where("lower(extension) <> '.xlsx'").unionByName(
        cat.where("lower(extension) = '.xlsx'").withColumn("extension", F.lit(".old"))), HarmonizeConfig(types=["xlsx"]))
