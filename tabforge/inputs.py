"""Inputs derived from the driver tables (the shared fixtures of every query).

* ``catalog``: a file catalog (S1 shape) generated from ``orders`` - one file
  per order, four name shapes chosen by the order key (bulk business names,
  invoices, camera photos, messy project names).
* ``customer_shards``: the ``customer`` table written as CSV shards with three
  header styles (messy folder input for S3/H*/I*).
* ``event_log`` / ``series``: operation-log and time-series views of ``events``.

The catalog and log are written as portable SQL so the same text builds the
input in Spark and in the DuckDB oracle; the operators under test are never
expressed here.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import staging_path

# Words of the generated names. Some are words that the business tables know, others are not.
DEPARTMENTS = ["Legal", "IT", "Logistics", "HR", "Finance", "Research"]
DOC_TYPES = ["invoice", "report", "memo", "contract", "minutes", "policy"]
STATUSES = ["final", "pending", "draft", "signed", "approved"]
EXTENSIONS = [".txt", ".pdf", ".docx", ".xlsx"]
COMPANIES = ["AcmeCorp", "GlobexInc", "Initech", "UmbrellaLtd", "StarkCo"]
CLIENTS = ["Nike", "Apple", "Tesla", "Adobe", "Spotify"]
PROJECTS = ["brand refresh", "Launch-Campaign", "web site", "Q3 deck", "logo_pack"]


def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} % {len(values)} {arms} END"


def _d8(col: str) -> str:
    return f"CAST(year({col}) * 10000 + month({col}) * 100 + day({col}) AS STRING)"


def _iso(col: str) -> str:
    return (f"CAST(year({col}) AS STRING) || '-' || lpad(CAST(month({col}) AS STRING), 2, '0') || '-' || "
            f"lpad(CAST(day({col}) AS STRING), 2, '0')")


def catalog_select(orders: str = "orders") -> str:
    """Portable SQL (Spark and DuckDB) for the generated catalog."""
    dept = _case("o_custkey", DEPARTMENTS)
    typ = _case("o_orderkey", DOC_TYPES)
    status = _case("o_orderkey", STATUSES)
    ext = _case("CAST(floor(o_orderkey / 4) AS BIGINT)", EXTENSIONS)
    company = _case("o_custkey", COMPANIES)
    client = _case("o_custkey", CLIENTS)
    project = _case("CAST(floor(o_orderkey / 4) AS BIGINT)", PROJECTS)
    seq = "lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')"
    hhmmss = ("lpad(CAST((o_orderkey * 7) % 24 AS STRING), 2, '0') || lpad(CAST((o_orderkey * 13) % 60 AS STRING), 2, '0') || "
              "lpad(CAST((o_orderkey * 17) % 60 AS STRING), 2, '0')")
    ver = "CAST(1 + o_orderkey % 3 AS STRING) || '.' || CAST(o_custkey % 10 AS STRING)"
    name = (
        f"CASE o_orderkey % 4 "
        f"WHEN 0 THEN {dept} || '_' || {typ} || '_' || {status} || '_' || {_d8('o_orderdate')} || '_' || {seq} || {ext} "
        f"WHEN 1 THEN 'Invoice_' || CAST(o_orderkey AS STRING) || '_' || {company} || '_' || {_iso('o_orderdate')} || '.pdf' "
        f"WHEN 2 THEN 'IMG_' || {_d8('o_orderdate')} || '_' || {hhmmss} || '.jpg' "
        f"ELSE {client} || ' ' || {project} || ' v' || {ver} || ' (' || {status} || ') ' || {_d8('o_orderdate')} || '.DOCX' END"
    )
    return (
        f"SELECT o_orderkey AS file_id, file_name, folder || file_name AS path, folder AS parent_dir, size, created, modified FROM ("
        # names without a number of their own stand in folders of their own: a path is one file
        f"SELECT o_orderkey, '/archive/' || lower({dept}) || '/' || CASE WHEN o_orderkey % 4 < 2 THEN '' ELSE CAST(o_orderkey AS STRING) || '/' END AS folder, {name} AS file_name, CAST(floor(o_totalprice) AS BIGINT) AS size, "
        f"o_orderdate - INTERVAL 30 DAY AS created, o_orderdate AS modified FROM {orders}) g"
    )


def set_extension(spark: SparkSession, folder: str, ext: str) -> None:
    """Give the part files Spark's text writer produced (``.txt``) the extension ``ext``.

    Fixture helper: a metadata-only rename of the few part files through the
    Hadoop FileSystem API (works on any cluster file system).
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # looked up once: each part of the name is a call
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = path(folder)
    fs = root.getFileSystem(conf)
    todo = [root]
    while todo:
        for entry in fs.listStatus(todo.pop()):  # listFiles would ask for each local file's owner by a command of its own
            p = entry.getPath()
            name = p.getName()
            if entry.isDirectory():
                todo.append(p)
            elif name.startswith("part-") and name.endswith(".txt"):
                fs.rename(p, path(p.getParent(), name[:-4] + ext))


def by_bucket(df: DataFrame, key: str, rows: int = 1000) -> DataFrame:
    """``df`` with ``b``, a bucket of ``rows`` keys, dealt by it to as many tasks as the session has shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("b", F.floor(F.col(key) / rows)).repartition(n, "b")


def write_documents(docs: DataFrame, folder: str, ext: str = ".json") -> None:
    """Write the column ``value`` as one file for each row, all in ``folder`` itself: a folder for each file would have to
    be listed by a task of its own whenever the files are read."""
    docs.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    set_extension(docs.sparkSession, folder, ext)


def write_workbook(spark: SparkSession, path: str, sheets: dict[str, list[list]]) -> None:
    """Write a small workbook (inline strings and numbers) through the Hadoop FileSystem API: a fixture."""
    def cell(r, c, v):
        ref = f"{chr(65 + c)}{r + 1}"
        return f'<c r="{ref}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r + 1}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows))
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data.getvalue()))
    out.close()


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_WRITTEN: dict[tuple, str] = {}


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows: file_id, path, file_name, base_name, extension, parent, size, created, modified.

    The generated catalog is written once per session as Parquet below the
    shared staging folder and read back, like a catalog table a user would
    keep: the queries then start from a plain scan.
    """
    from .sources.catalog import with_name_parts
    key = (id(spark), sf_dir)
    if key not in _WRITTEN:
        orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        df = spark.sql(catalog_select("{orders}"), orders=orders)
        df = with_name_parts(df.drop("file_name", "parent_dir")).select(
            "file_id", "path", "file_name", "base_name", "extension", "parent", "size", "created", "modified")
        path = staging_path(spark, "catalog")
        df.write.mode("overwrite").parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def catalog_cte() -> str:
    """DuckDB CTE with the same catalog columns as :func:`catalog`."""
    base = catalog_select("orders")
    return (
        "catalog AS (SELECT file_id, path, file_name, "
        "CASE WHEN regexp_matches(file_name, '^.+\\.[^.]+$') THEN regexp_extract(file_name, '^(.+)\\.[^.]+$', 1) ELSE file_name END AS base_name, "
        "CASE WHEN regexp_matches(file_name, '^.+\\.[^.]+$') THEN regexp_extract(file_name, '^.+(\\.[^.]+)$', 1) ELSE '' END AS extension, "
        "rtrim(parent_dir, '/') AS parent, size, created, modified FROM (" + base + ") c)"
    )


# --- messy CSV shards of `customer` -------------------------------------------------
# Three header styles; each shard holds one nation-key range (together: the whole table).
SHARD_STYLES = [
    ("style_a", "c_nationkey < 8",
     [("Customer ID", "c_custkey"), ("Full Name", "concat(c_mktsegment, ' ', c_name)"),
      ("Nation Key", "c_nationkey"), ("Account Balance", "c_acctbal")]),
    ("style_b", "c_nationkey >= 8 AND c_nationkey < 16",
     [("cust_id", "c_custkey"), ("customer_name", "concat(c_mktsegment, ' ', c_name)"),
      ("NATION", "c_nationkey"), ("Balance", "c_acctbal"), ("Segment", "c_mktsegment")]),
    ("style_c", "c_nationkey >= 16",
     [("Client Id", "c_custkey"), ("Name", "concat(c_mktsegment, ' ', c_name)"),
      ("nation key", "CAST(c_nationkey AS STRING)"), ("account balance", "c_acctbal"), ("Notes", "'n/a'")]),
]
SHARD_SCHEMA_MAP = {
    "customer_id": ["cust_id", "Client Id"],
    "name": ["Full Name", "customer_name"],
    "nation_key": ["NATION"],
    "account_balance": ["Balance"],
}


def customer_shards(spark: SparkSession, sf_dir: str, files_per_shard: int = 2, fresh: bool = False) -> str:
    """Write the shards (CSV, header per file) below the shared staging folder; return the root.

    Written once per session and layout; queries that add files copy nothing
    and write into their own folders.
    """
    cached = ("shards", id(spark), sf_dir, files_per_shard)
    if cached in _WRITTEN and not fresh:
        return _WRITTEN[cached]
    root = staging_path(spark, "customer-shards")
    cust = _read(spark, sf_dir, "customer")
    for name, cond, cols in SHARD_STYLES:
        part = cust.filter(F.expr(cond)).select(*[F.expr(e).alias(h) for h, e in cols])
        key = cols[0][0]
        (part.repartitionByRange(files_per_shard, F.col(f"`{key}`")).sortWithinPartitions(F.col(f"`{key}`"))
             .write.mode("overwrite").option("header", "true").csv(f"{root}/{name}"))
    if not fresh:
        _WRITTEN[cached] = root
    return root


def customer_shards_oracle() -> str:
    """DuckDB rows of the harmonised shards (before numbering)."""
    return (
        "shards AS ("
        "SELECT 'style_a' AS shard, c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name, "
        "CAST(c_nationkey AS BIGINT) AS nation_key, c_acctbal AS account_balance, CAST(NULL AS VARCHAR) AS segment, "
        "CAST(NULL AS VARCHAR) AS notes FROM customer WHERE c_nationkey < 8 "
        "UNION ALL SELECT 'style_b', c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT), c_acctbal, c_mktsegment, NULL "
        "FROM customer WHERE c_nationkey >= 8 AND c_nationkey < 16 "
        "UNION ALL SELECT 'style_c', c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT), c_acctbal, NULL, 'n/a' "
        "FROM customer WHERE c_nationkey >= 16)"
    )
