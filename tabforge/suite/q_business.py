"""Business example operators over the generated catalog: X9, X11, C6, C7, C9, C15, S12, K3."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import inputs
from ..functions import convert as C
from ..functions import extract as X
from ..functions import naming as N
from ..plans import rename as R
from ..plans.spec import from_dict
from ..session import staging_path
from ..sources.oplog import read_operation_log
from ..sources.sinks import write_plan
from .q_naming import _map_sql, _title_sql
from .q_plan import PLAN_CTE, SPEC
from .registry import query

CAT = inputs.catalog_cte()


def cat(spark, sf_dir):
    return inputs.catalog(spark, sf_dir)


def _corp_sql(titled=False):
    arms = {f: [] for f in X.CORPORATE_FIELDS}
    for rx, names in X.CORPORATE_PATTERNS:
        for f in X.CORPORATE_FIELDS:
            v = f"regexp_extract(low, '{rx}', {names.index(f) + 1})" if f in names else "NULL"
            arms[f].append(f"WHEN regexp_matches(low, '{rx}') THEN {v}")
    fb = {"client": "coalesce(parts[1], 'unknown')", "doc_type": "CASE WHEN len(parts) > 1 THEN parts[2] ELSE 'document' END",
          "description": "CASE WHEN len(parts) > 2 THEN array_to_string(parts[3:], '_') ELSE 'general' END"}
    plain = {f: f"CASE {' '.join(arms[f])} ELSE {fb.get(f, 'NULL')} END" for f in X.CORPORATE_FIELDS}
    if titled:
        plain |= {f: _title_sql(f"replace({plain[f]}, '_', ' ')") for f in ("client", "dept", "doc_type", "status", "description")}
    cols = ", ".join(f"{e} AS {f}" for f, e in plain.items())
    return (f"WITH {CAT}, s AS (SELECT file_id, lower(base_name) AS low, regexp_split_to_array(lower(base_name), '[_-]') AS parts "
            f"FROM catalog) SELECT file_id, {cols} FROM s")


@query("extract_corporate", _corp_sql(titled=True))
def extract_corporate(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.x_corporate().alias("f")).select("file_id", "f.*")


def _project_sql():
    ver_arms = []
    for rx in X.PROJECT_VERSION:
        import re
        two = re.compile(rx).groups == 2
        v = (f"regexp_extract(base_name, '{rx}', 1) || '.' || regexp_extract(base_name, '{rx}', 2)" if two
             else f"regexp_extract(base_name, '{rx}', 1)")
        ver_arms.append(f"WHEN regexp_matches(base_name, '{rx}') THEN {v}")
    st_arms = " ".join("WHEN " + " OR ".join(f"contains(lower(base_name), '{k}')" for k in kws) + f" THEN '{lbl}'"
                       for lbl, kws in X.PROJECT_STATUS.items())
    dt_arms = " ".join(f"WHEN regexp_matches(base_name, '{rx}') THEN regexp_extract(base_name, '{rx}', 1)" for rx in X.PROJECT_DATE)
    cl_arms = " ".join(f"WHEN contains(lower(base_name), lower('{c}')) THEN '{c}'" for c in inputs.CLIENTS)
    rest = "base_name"
    for f in ("client", "version", "status", "date"):
        rest = f"CASE WHEN {f} <> 'unknown' AND {f} <> '' THEN replace({rest}, {f}, '') ELSE {rest} END"
    return (f"WITH {CAT}, s AS (SELECT file_id, base_name, CASE {cl_arms} ELSE 'unknown' END AS client, "
            f"CASE {' '.join(ver_arms)} ELSE 'unknown' END AS version, CASE {st_arms} ELSE 'unknown' END AS status, "
            f"CASE {dt_arms} ELSE 'unknown' END AS date FROM catalog), "
            f"r AS (SELECT *, regexp_replace(regexp_replace({rest}, '[_\\-.]+', '_', 'g'), '^[_\\-.]+|[_\\-.]+$', '', 'g') AS rest FROM s) "
            f"SELECT file_id, client, version, status, date, CASE WHEN rest = '' THEN 'unknown' ELSE rest END AS project FROM r")


@query("extract_project", _project_sql())
def extract_project(spark, sf_dir):
    """Client from a known list, version / status / date cascades, residual project name."""
    return cat(spark, sf_dir).select("file_id", X.x_project(inputs.CLIENTS).alias("f")).select("file_id", "f.*")


@query("parse_date_any", f"WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 4) AS d FROM catalog), "
       "p AS (SELECT file_id, CASE WHEN length(d) = 8 THEN try_strptime(d, '%Y%m%d') WHEN contains(d, '-') "
       "THEN try_strptime(d, '%Y-%m-%d') END AS t FROM s) "
       "SELECT file_id, strftime(t, '%Y-%m-%d') AS iso, strftime(t, '%Y%m%d') AS compact, strftime(t, '%Y') AS year, "
       "strftime(t, '%m') AS month FROM p")
def parse_date_any(spark, sf_dir):
    """8-character or dashed dates -> iso, compact, year, month."""
    d = F.split_part(F.col("base_name"), F.lit("_"), F.lit(4))
    t = C.parse_date_any(d)
    return cat(spark, sf_dir).select("file_id", F.date_format(t, "yyyy-MM-dd").alias("iso"),
                                     F.date_format(t, "yyyyMMdd").alias("compact"),
                                     F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"))


@query("business_record", f"""WITH {CAT}, s AS (SELECT file_id, base_name,
  CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 1) ELSE 'misc' END AS dept,
  CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 2) ELSE base_name END AS type,
  CASE WHEN len(string_split(base_name, '_')) >= 3 THEN split_part(base_name, '_', 3) ELSE 'unknown' END AS date FROM catalog),
t AS (SELECT *, CASE WHEN dept <> '' THEN {_map_sql('dept', C.DEPT_NAMES)} END AS dept_full,
  CASE WHEN type <> '' THEN {_map_sql('type', C.TYPE_NAMES)} END AS type_formatted,
  CASE WHEN date <> '' AND date <> 'unknown' AND (length(date) = 8 OR contains(date, '-')) THEN coalesce(strftime(
    CASE WHEN length(date) = 8 THEN try_strptime(date, '%Y%m%d') ELSE try_strptime(date, '%Y-%m-%d') END, '%Y-%m-%d'), 'unknown') END AS date_iso FROM s)
SELECT file_id, dept_full, type_formatted, date_iso,
  CASE WHEN dept_full IS NOT NULL AND type_formatted IS NOT NULL AND date_iso IS NOT NULL THEN dept_full || '_' || type_formatted || '_' || date_iso
       WHEN dept_full IS NOT NULL AND type_formatted IS NOT NULL THEN dept_full || '_' || type_formatted ELSE base_name END AS formatted_name FROM t""")
def business_record(spark, sf_dir):
    """C7 over X6: standardised department / type, ISO date, formatted name."""
    r = cat(spark, sf_dir).select("file_id", "base_name", X.x_business_doc().alias("fields"))
    r = r.select("file_id", C.c_business("fields").alias("b"))
    return r.select("file_id", "b.dept_full", "b.type_formatted", "b.date_iso", "b.formatted_name")


def _inv_sql(field_idx, fallback, date=False):
    P = X.INVOICE_PATTERNS
    if date:
        return (f"CASE WHEN regexp_matches(base_name, '{P[0]}') THEN coalesce(nullif(regexp_extract(base_name, '{P[0]}', 3), ''), "
                f"'unknown') ELSE 'unknown' END")
    arms = " ".join(f"WHEN regexp_matches(base_name, '{p}') THEN regexp_extract(base_name, '{p}', {field_idx})" for p in P)
    return f"CASE {arms} ELSE '{fallback}' END"


@query("invoice_record", f"""WITH {CAT}, s AS (SELECT file_id, {_inv_sql(2, 'unknown')} AS company,
  {_inv_sql(1, 'unknown')} AS number, {_inv_sql(0, 'unknown', date=True)} AS date FROM catalog),
t AS (SELECT file_id, CASE WHEN company <> 'unknown' THEN {_title_sql("regexp_replace(trim(regexp_replace(regexp_replace(company, '(?i)\\b(inc|ltd|llc|corp|co)\\b', '', 'g'), '[^\\w\\s-]', '', 'g')), '\\s+', '-', 'g')")} ELSE 'Unknown-Company' END AS company_clean,
  CASE WHEN number <> 'unknown' AND TRY_CAST(number AS BIGINT) IS NOT NULL THEN lpad(CAST(CAST(number AS BIGINT) AS VARCHAR), 6, '0') WHEN number <> 'unknown' THEN number ELSE '000000' END AS number_padded,
  CASE WHEN date <> 'unknown' AND contains(date, '-') THEN coalesce(strftime(try_strptime(date, '%Y-%m-%d'), '%Y-%m-%d'), 'unknown') WHEN date <> 'unknown' THEN date ELSE 'unknown' END AS date_formatted FROM s)
SELECT file_id, company_clean, number_padded, date_formatted,
  CASE WHEN date_formatted <> 'unknown' THEN company_clean || '_Invoice_' || number_padded || '_' || date_formatted
       ELSE company_clean || '_Invoice_' || number_padded END AS formatted_name FROM t""")
def invoice_record(spark, sf_dir):
    """C9 over X7 on every catalog name (non-invoice names take the defaults)."""
    r = cat(spark, sf_dir).select("file_id", C.c_invoice(X.x_invoice()).alias("r"))
    return r.select("file_id", "r.company_clean", "r.number_padded", "r.date_formatted", "r.formatted_name")


@query("classify_document", f"""WITH {CAT}, s AS (SELECT file_id, lower(file_name) AS low, lower(split_part(base_name, '_', 1)) AS d,
  lower(split_part(base_name, '_', 2)) AS t FROM catalog)
SELECT file_id, CASE
  WHEN d IN ('legal', 'law') THEN CASE WHEN contains(t, 'contract') OR contains(low, 'contract') THEN 'Legal-Contract'
    WHEN contains(t, 'agreement') OR contains(low, 'agreement') THEN 'Legal-Agreement'
    WHEN contains(t, 'compliance') OR contains(low, 'compliance') THEN 'Legal-Compliance' ELSE 'General-Document' END
  WHEN d IN ('finance', 'fin') THEN CASE WHEN contains(t, 'audit') OR contains(low, 'audit') THEN 'Finance-Audit'
    WHEN contains(t, 'budget') OR contains(low, 'budget') THEN 'Finance-Budget'
    WHEN contains(t, 'financial') OR contains(low, 'financial') THEN 'Finance-Statement' ELSE 'General-Document' END
  WHEN d IN ('hr', 'human resources') THEN CASE WHEN contains(t, 'policy') OR contains(low, 'policy') THEN 'HR-Policy'
    WHEN contains(t, 'handbook') OR contains(low, 'handbook') THEN 'HR-Handbook'
    WHEN contains(t, 'training') OR contains(low, 'training') THEN 'HR-Training' ELSE 'General-Document' END
  ELSE 'General-Document' END AS classification FROM s""")
def classify_document(spark, sf_dir):
    """Department-specific classification of each file."""
    c = cat(spark, sf_dir).select("file_id", "file_name", X.x_split("_", "dept", "type").alias("f"))
    return c.select("file_id", C.classify_document("f.dept", "f.type", "file_name").alias("classification"))


@query("operation_log_scan", """SELECT event_id, CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  'app.' || event_type AS logger, CAST(event_id % 500 AS INTEGER) AS line, CAST(user_id AS VARCHAR) AS user_id,
  event_type = 'error' AS has_exception, CASE WHEN event_type = 'error' THEN 2 END AS traceback_lines FROM events""")
def operation_log_scan(spark, sf_dir):
    """Events written as JSON log lines (extras + exception blocks) and scanned back."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    exc = F.when(F.col("event_type") == "error", F.struct(
        F.lit("ValueError").alias("type"), F.concat(F.lit("bad value "), F.col("value").cast("string")).alias("message"),
        F.array(F.lit("Traceback (most recent call last):"), F.lit("ValueError")).alias("traceback")))
    rec = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                   F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
                   F.concat(F.lit("app."), F.col("event_type")).alias("logger"), F.lit("event").alias("message"),
                   F.lit("worker").alias("module"), F.lit("handle").alias("function"),
                   (F.col("event_id") % 500).cast("int").alias("line"), F.col("event_id"), F.col("user_id"),
                   exc.alias("exception"))
    path = staging_path(spark, "oplog")
    ev.select(F.to_json(rec).alias("value")).write.mode("overwrite").text(path)
    log = read_operation_log(spark, path)
    return log.select(F.col("extra")["event_id"].cast("bigint").alias("event_id"), "level", "logger", "line",
                      F.col("extra")["user_id"].alias("user_id"), F.col("exception").isNotNull().alias("has_exception"),
                      F.size("exception.traceback").alias("traceback_lines"))


@query("plan_sink", f"""WITH {PLAN_CTE}
SELECT CASE WHEN NOT kept THEN 'filtered' WHEN old_name = new_name THEN 'keep' ELSE 'rename' END AS action, count(*) AS files
FROM plan GROUP BY 1""")
def plan_sink(spark, sf_dir):
    """K3: persist the plan partitioned by action, read the partitions back."""
    plan = R.rename_plan(cat(spark, sf_dir), from_dict(SPEC)).drop("fields")
    plan = plan.withColumn("action", F.when(~F.col("kept"), F.lit("filtered"))
                           .when(F.col("old_name") == F.col("new_name"), F.lit("keep")).otherwise(F.lit("rename")))
    path = write_plan(plan, staging_path(spark, "plan"))
    return spark.read.parquet(path).groupBy("action").agg(F.count(F.lit(1)).cast("bigint").alias("files"))


@query("rename_business", f"""WITH {CAT}, s AS (SELECT file_id, base_name,
  CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 1) ELSE 'misc' END AS dept,
  CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 2) ELSE base_name END AS type,
  CASE WHEN len(string_split(base_name, '_')) >= 3 THEN split_part(base_name, '_', 3) ELSE 'unknown' END AS date FROM catalog),
t AS (SELECT file_id, {_map_sql('dept', N.A_DEPT_NAMES)} AS d, {_map_sql('type', N.A_TYPE_NAMES)} AS ty,
  CASE WHEN date <> 'unknown' AND length(date) = 8 THEN coalesce(strftime(try_strptime(date, '%Y%m%d'), '%Y-%m-%d'), date) ELSE date END AS dt FROM s)
SELECT file_id, CASE WHEN dt <> 'unknown' THEN d || '_' || ty || '_' || dt ELSE d || '_' || ty END AS new_base FROM t""")
def rename_business(spark, sf_dir):
    """A4: business documents in one step."""
    return cat(spark, sf_dir).select("file_id", N.a_business().alias("new_base"))


@query("rename_invoices", f"""WITH {CAT}, s AS (SELECT file_id, base_name, {_inv_sql(2, 'unknown')} AS company,
  {_inv_sql(1, 'unknown')} AS number, {_inv_sql(0, 'unknown', date=True)} AS date FROM catalog),
t AS (SELECT file_id, date, CASE WHEN company <> 'unknown' THEN {_title_sql("regexp_replace(trim(regexp_replace(regexp_replace(company, '(?i)\\b(inc|ltd|llc|corp|co)\\b', '', 'g'), '[^\\w\\s-]', '', 'g')), '\\s+', '-', 'g')")} ELSE 'Unknown-Company' END AS comp,
  CASE WHEN number <> 'unknown' AND TRY_CAST(trim(number) AS BIGINT) IS NOT NULL THEN lpad(CAST(CAST(trim(number) AS BIGINT) AS VARCHAR), 8, '0')
       WHEN number <> 'unknown' THEN number ELSE '00000000' END AS num FROM s)
SELECT file_id, CASE WHEN date <> 'unknown' THEN 'Invoice_' || num || '_' || comp || '_' || date ELSE 'Invoice_' || num || '_' || comp END AS new_base FROM t""")
def rename_invoices(spark, sf_dir):
    """A5: invoices in one step (number first, 8-digit padding)."""
    return cat(spark, sf_dir).select("file_id", N.a_invoices(company_prefix=False, number_padding=8).alias("new_base"))


@query("rename_media", f"""WITH {CAT}, s AS (SELECT file_id, base_name,
  CASE WHEN lower(extension) IN ('.jpg', '.jpeg', '.png', '.gif', '.bmp', '.tiff', '.webp') THEN 'Image'
       WHEN lower(extension) IN ('.mp4', '.avi', '.mov', '.mkv', '.wmv', '.flv', '.webm') THEN 'Video'
       WHEN lower(extension) IN ('.mp3', '.wav', '.flac', '.aac', '.ogg', '.m4a') THEN 'Audio' ELSE 'Unknown' END AS kind,
  nullif(regexp_extract(base_name, '(\\d{{8}})', 1), '') AS d, nullif(regexp_extract(base_name, '(\\d{{6}})', 1), '') AS t,
  trim(regexp_replace(regexp_replace(base_name, '[\\d_\\-.]+', '', 'g'), '[^\\w\\s]', '', 'g')) AS rest FROM catalog),
n AS (SELECT file_id, base_name, concat_ws('_', d, t, kind, CASE WHEN length(rest) > 3 THEN {_title_sql('rest')} END) AS nm FROM s)
SELECT file_id, CASE WHEN length(nm) > 40 THEN substr(nm, 1, 37) || '...' ELSE nm END AS new_base FROM n""")
def rename_media(spark, sf_dir):
    """Media files in one step (40-character cap)."""
    return cat(spark, sf_dir).select("file_id", N.a_media(max_length=40).alias("new_base"))


@query("name_creative", f"""WITH {CAT}, s AS (SELECT file_id, split_part(base_name, ' ', 1) AS artist,
  split_part(base_name, ' ', 2) AS type, split_part(base_name, ' ', 3) AS dimensions, split_part(base_name, ' ', 4) AS date FROM catalog),
c AS (SELECT *, regexp_replace(lower(dimensions), '[^\\dx]', '', 'g') AS cd FROM s)
SELECT file_id, concat_ws('_', replace(regexp_replace(artist, '[^\\w\\s-]', '', 'g'), ' ', '_'), lower(replace(type, ' ', '_')),
  CASE WHEN (CASE WHEN cd <> '' THEN cd ELSE dimensions END) <> '' THEN (CASE WHEN cd <> '' THEN cd ELSE dimensions END) END,
  CASE WHEN date <> '' THEN date END) AS name FROM c""")
def name_creative(spark, sf_dir):
    """T6 over a space split of each name (artist, type, dimensions, date)."""
    c = cat(spark, sf_dir).select("file_id", "base_name", X.x_split(" ", "artist", "type", "dimensions", "date").alias("fields"))
    return c.select("file_id", N.t_creative(fields_type=c.schema["fields"].dataType).alias("name"))


@query("name_project", _project_sql().replace(
    "SELECT file_id, client, version, status, date, CASE WHEN rest = '' THEN 'unknown' ELSE rest END AS project FROM r",
    ", p AS (SELECT file_id, version, status, date, CASE WHEN rest = '' THEN 'unknown' ELSE rest END AS project FROM r) "
    "SELECT file_id, concat_ws('_', 'PRJ', replace(project, ' ', '-'), CASE WHEN version = '' THEN NULL WHEN starts_with(version, 'v') "
    "THEN version ELSE 'v' || version END, CASE WHEN lower(status) IN ('draft', 'review', 'final', 'archive') THEN "
    "upper(substr(lower(status), 1, 1)) || substr(lower(status), 2) END, CASE WHEN length(regexp_replace(date, '[^0-9]', '', 'g')) >= 6 "
    "THEN substr(regexp_replace(date, '[^0-9]', '', 'g'), 1, 8) END) AS name FROM p"))
def name_project(spark, sf_dir):
    """T5 over X9 fields, with a project prefix."""
    c = cat(spark, sf_dir).select("file_id", "base_name", X.x_project(inputs.CLIENTS).alias("fields"))
    return c.select("file_id", N.t_project(fields_type=c.schema["fields"].dataType, project_prefix="PRJ").alias("name"))


@query("document_record", f"""WITH {CAT}, s AS (SELECT file_id, base_name,
  CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 1) ELSE 'misc' END AS dept,
  CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 2) ELSE base_name END AS type,
  CASE WHEN len(string_split(base_name, '_')) >= 3 THEN split_part(base_name, '_', 3) ELSE 'unknown' END AS date FROM catalog),
n AS (SELECT file_id, base_name, dept, type, date, concat_ws('_', CASE WHEN type NOT IN ('', 'unknown') THEN replace(type, ' ', '-') END,
  CASE WHEN date NOT IN ('', 'unknown') THEN replace(date, '-', '') END) AS j FROM s)
SELECT file_id, CASE WHEN j = '' THEN substr(base_name, 1, 30) WHEN length(j) > 30 THEN substr(j, 1, 27) || '...' ELSE j END AS formatted_name,
  coalesce(nullif(concat_ws('/', CASE WHEN dept NOT IN ('', 'unknown') THEN upper(dept) END,
    CASE WHEN date NOT IN ('', 'unknown') AND contains(date, '-') THEN split_part(date, '-', 1)
         WHEN date NOT IN ('', 'unknown') AND length(date) >= 6 THEN substr(date, 1, 4) END,
    CASE WHEN date NOT IN ('', 'unknown') AND contains(date, '-') THEN split_part(date, '-', 2)
         WHEN date NOT IN ('', 'unknown') AND length(date) >= 6 THEN substr(date, 5, 2) END,
    CASE WHEN type NOT IN ('', 'unknown') THEN replace(type, ' ', '-') END), ''), 'Documents') AS suggested_folder FROM n""")
def document_record(spark, sf_dir):
    """C12 over X6 fields: name with a 30-character cap, department and date folders."""
    c = cat(spark, sf_dir).select("file_id", "base_name", X.x_business_doc().alias("fields"))
    r = c.select("file_id", N.c_document(date_folders=True, max_len=30).alias("r"))
    return r.select("file_id", "r.formatted_name", "r.suggested_folder")


@query("rename_photos", f"""WITH {CAT}, s AS (SELECT file_id, base_name, modified, regexp_extract(base_name, '(\\d{{8}})', 1) AS d8,
  regexp_extract(base_name, '(\\d{{6}})', 1) AS t6 FROM catalog),
p AS (SELECT *, CASE WHEN d8 <> '' THEN try_strptime(d8, '%Y%m%d') ELSE modified END AS dday,
  d8 <> '' AND try_strptime(d8, '%Y%m%d') IS NULL AS bad FROM s)
SELECT file_id, concat_ws('_', CASE WHEN NOT bad THEN strftime(dday, '%Y-%m') END,
  CASE WHEN bad THEN d8 ELSE coalesce(strftime(dday, '%Y%m%d'), 'unknown-date') END, nullif(t6, ''),
  CASE WHEN regexp_matches(base_name, '(?i)^(IMG|DSC|DCIM|P\\d+)_') THEN regexp_extract(base_name, '(?i)^(IMG|DSC|DCIM|P\\d+)_', 1)
       WHEN regexp_matches(base_name, '(?i)(iPhone|Samsung|Pixel|Canon|Nikon|Sony)')
       THEN regexp_extract(base_name, '(?i)(iPhone|Samsung|Pixel|Canon|Nikon|Sony)', 1) ELSE 'Camera' END,
  CASE WHEN contains(upper(base_name), 'VID') THEN 'Video' WHEN contains(upper(base_name), 'SCR') OR contains(base_name, 'Screenshot')
       THEN 'Screenshot' ELSE 'Photo' END) AS new_base FROM p""")
def rename_photos(spark, sf_dir):
    """Photos in one step (month folder, date, time, device, type)."""
    return cat(spark, sf_dir).select("file_id", N.a_photos(include_device=True).alias("new_base"))


def _lmap_sql(v, mapping):
    arms = " ".join(f"WHEN {v} = '{k}' THEN '{val}'" for k, val in mapping.items())
    return f"CASE {arms} ELSE {_title_sql(v)} END"


@query("name_business", f"""WITH {CAT}, s AS (SELECT file_id, lower(split_part(base_name, '_', 1)) AS d,
  lower(split_part(base_name, '_', 2)) AS t, split_part(base_name, '_', 4) AS date FROM catalog),
n AS (SELECT file_id, {_lmap_sql('d', N.T_DEPT_NAMES)} AS dept, {_lmap_sql('t', N.T_TYPE_NAMES)} AS typ,
  CASE WHEN date = '' THEN '2000-01-01' WHEN regexp_matches(date, '^[0-9]{{8}}$')
       THEN coalesce(strftime(try_strptime(date, '%Y%m%d'), '%Y-%m-%d'), date) ELSE date END AS dt FROM s)
SELECT file_id, concat_ws('_', CASE WHEN dept <> 'Unknown' THEN dept END, typ, dt) AS name FROM n""")
def name_business(spark, sf_dir):
    """T4 over split fields dept/type/-/date; missing dates take the given day."""
    c = cat(spark, sf_dir).select("file_id", "base_name", X.x_split("_", "dept", "type", "status", "date").alias("fields"))
    return c.select("file_id", N.t_business("2000-01-01", fields_type=c.schema["fields"].dataType).alias("name"))


@query("project_record", _project_sql().replace(
    "SELECT file_id, client, version, status, date, CASE WHEN rest = '' THEN 'unknown' ELSE rest END AS project FROM r",
    ", p AS (SELECT file_id, client, version, status, date, CASE WHEN rest = '' THEN 'unknown' ELSE rest END AS project FROM r) "
    "SELECT file_id, concat_ws('_', CASE WHEN client NOT IN ('', 'unknown') THEN replace(client, ' ', '-') END, "
    "CASE WHEN project NOT IN ('', 'unknown') THEN replace(project, ' ', '-') ELSE 'Project' END, "
    "CASE WHEN version NOT IN ('', 'unknown') THEN 'v' || version END, "
    "CASE WHEN date NOT IN ('', 'unknown') THEN replace(replace(date, '-', ''), '_', '') END) AS formatted_name, "
    "coalesce(nullif(concat_ws('/', CASE WHEN client NOT IN ('', 'unknown') THEN client END, "
    "CASE WHEN project NOT IN ('', 'unknown') THEN project END), ''), 'Projects') || CASE WHEN status NOT IN ('', 'unknown') THEN "
    "CASE status WHEN 'archive' THEN '/Archive' WHEN 'final' THEN '/Final' WHEN 'draft' THEN '/Work-in-Progress' ELSE '' END "
    "ELSE '' END AS suggested_folder FROM p"))
def project_record(spark, sf_dir):
    """C11 over X9 fields: formatted name and suggested folder with status subfolder."""
    c = cat(spark, sf_dir).select("file_id", X.x_project(inputs.CLIENTS).alias("fields"))
    r = c.select("file_id", N.c_project().alias("r"))
    return r.select("file_id", "r.formatted_name", "r.suggested_folder")


def _photo_record_sql():
    from .registry import ORACLE
    base = ORACLE["extract_photo"]
    return (f"WITH x AS ({base}) SELECT x.file_id, coalesce(nullif(concat_ws('_', "
            "CASE WHEN date NOT IN ('', 'unknown') THEN replace(date, '-', '') END, "
            "CASE WHEN time NOT IN ('', 'unknown') THEN replace(time, '-', '') END, "
            "CASE WHEN device NOT IN ('', 'unknown') THEN device END, "
            "CASE WHEN type <> '' AND type <> 'Photo' THEN type END), ''), c.base_name) AS formatted_name, "
            "CASE WHEN date NOT IN ('', 'unknown') THEN 'Photos/' || split_part(date, '-', 1) || '-' || split_part(date, '-', 2) "
            "WHEN year IS NOT NULL AND year <> '' THEN 'Photos/' || year ELSE 'Photos/Unsorted' END AS suggested_folder "
            f"FROM x JOIN (SELECT file_id, base_name FROM ({inputs.catalog_cte().split(' AS (', 1)[1][:-1]}) cc) c USING (file_id)")


@query("photo_record", _photo_record_sql())
def photo_record(spark, sf_dir):
    """C10 over X8 fields, with device, grouped by month."""
    c = cat(spark, sf_dir).select("file_id", "base_name", X.x_photo().alias("fields"))
    r = c.select("file_id", C.c_photo("fields", include_device=True).alias("r"))
    return r.select("file_id", "r.formatted_name", "r.suggested_folder")


def _a7_sql():
    import re as _re
    ver_arms = []
    for rx in X.PROJECT_VERSION:
        two = _re.compile(rx).groups == 2
        v = (f"regexp_extract(base_name, '{rx}', 1) || '.' || regexp_extract(base_name, '{rx}', 2)" if two
             else f"regexp_extract(base_name, '{rx}', 1)")
        ver_arms.append(f"WHEN regexp_matches(base_name, '{rx}') THEN {v}")
    st_arms = " ".join("WHEN " + " OR ".join(f"contains(lower(base_name), '{k}')" for k in kws) + f" THEN '{lbl}'"
                       for lbl, kws in X.PROJECT_STATUS.items())
    dt_arms = " ".join(f"WHEN regexp_matches(base_name, '{rx}') THEN regexp_replace(regexp_extract(base_name, '{rx}', 1), '[-_]', '', 'g')"
                       for rx in X.PROJECT_DATE)
    cl_arms = " ".join(f"WHEN contains(lower(base_name), lower('{c}')) THEN '{c.replace(' ', '-')}'" for c in inputs.CLIENTS)
    rest = "base_name"
    for f in ("client", "version", "status", "date"):
        rest = f"CASE WHEN {f} <> 'unknown' THEN replace({rest}, {f}, '') ELSE {rest} END"
    return (f"WITH {CAT}, s AS (SELECT file_id, base_name, CASE {cl_arms} ELSE 'unknown' END AS client, "
            f"CASE {' '.join(ver_arms)} ELSE 'unknown' END AS version, CASE {st_arms} ELSE 'unknown' END AS status, "
            f"CASE {dt_arms} ELSE 'unknown' END AS date FROM catalog), "
            f"r AS (SELECT *, regexp_replace(regexp_replace({rest}, '[_\\-.]+', '_', 'g'), '^[_\\-.]+|[_\\-.]+$', '', 'g') AS rest FROM s) "
            "SELECT file_id, concat_ws('_', CASE WHEN client <> 'unknown' THEN client END, CASE WHEN rest = '' THEN 'Project' ELSE rest END, "
            "CASE WHEN version <> 'unknown' THEN 'v' || version END, CASE WHEN status <> 'unknown' THEN "
            "upper(substr(status, 1, 1)) || lower(substr(status, 2)) END, CASE WHEN date <> 'unknown' THEN date END) AS new_base FROM r")


@query("rename_projects", _a7_sql())
def rename_projects(spark, sf_dir):
    """Project files in one step."""
    return cat(spark, sf_dir).select("file_id", N.a_projects(inputs.CLIENTS).alias("new_base"))


def _clean_sql(v):
    return (f"array_to_string(list_transform(list_filter(regexp_split_to_array(regexp_replace({v}, '[_-]', ' ', 'g'), '\\s+'), "
            f"lambda w: w <> ''), lambda w: CASE WHEN upper(w) IN ('API', 'UI', 'UX', 'IT', 'HR', 'QA') THEN upper(w) "
            f"ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), '-')")


def _hier_sql():
    corp = _corp_sql()
    dmap = " ".join(f"WHEN trim(lower(dr)) = '{k}' THEN '{v}'" for k, v in N.H_DEPT_NAMES.items())
    suff = " ".join(f"WHEN ends_with(cu, '-{o}') THEN substr(cu, 1, length(cu) - {len(o)}) || '{n}'" for o, n in N.H_SUFFIXES)
    q8 = ("CASE WHEN length(date) = 8 AND TRY_CAST(substr(date, 1, 4) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(date, 5, 2) AS INTEGER) IS NOT NULL "
          "THEN CAST(TRY_CAST(substr(date, 1, 4) AS INTEGER) AS VARCHAR) || '-Q' || CAST(CAST(floor((TRY_CAST(substr(date, 5, 2) AS INTEGER) - 1) / 3) AS INTEGER) + 1 AS VARCHAR) "
          "WHEN length(date) = 6 AND TRY_CAST(substr(date, 1, 2) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(date, 5, 2) AS INTEGER) IS NOT NULL "
          "THEN CAST(2000 + TRY_CAST(substr(date, 5, 2) AS INTEGER) AS VARCHAR) || '-Q' || CAST(CAST(floor((TRY_CAST(substr(date, 1, 2) AS INTEGER) - 1) / 3) AS INTEGER) + 1 AS VARCHAR) "
          "ELSE '2000-Q1' END")
    return (f"WITH x AS ({corp}), e AS (SELECT x.*, c.extension FROM x JOIN (SELECT file_id, extension FROM "
            f"({inputs.catalog_cte().split(' AS (', 1)[1][:-1]}) cc) c USING (file_id)), "
            f"y AS (SELECT *, coalesce(dept, doc_type, 'General') AS dr, upper(replace(replace(coalesce(client, 'Unknown'), '_', '-'), ' ', '-')) AS cu, "
            f"coalesce(doc_type, 'Document') AS dt, CASE WHEN starts_with(version, 'v') THEN version ELSE 'v' || version END AS vv, {q8} AS q FROM e), "
            f"z AS (SELECT *, CASE {dmap} ELSE replace({_title_sql('dr')}, ' ', '-') END AS dep, CASE {suff} ELSE cu END AS cl, "
            "CASE WHEN version IS NOT NULL AND version <> '' THEN CASE WHEN regexp_matches(vv, '^v(\\d+)\\.(\\d+)') THEN 'v' || "
            "lpad(CAST(CAST(regexp_extract(vv, '^v(\\d+)\\.(\\d+)', 1) AS INTEGER) AS VARCHAR), 2, '0') || '.' || regexp_extract(vv, '^v(\\d+)\\.(\\d+)', 2) "
            f"ELSE vv END WHEN status IS NOT NULL AND status <> '' THEN {_clean_sql('status')} END AS sv FROM y) "
            f"SELECT file_id, dep || '/' || cl || '/' || CASE WHEN q IS NULL OR length(q) < 6 THEN '2024-Q1' ELSE q END || '/' || "
            f"concat_ws('-', {_clean_sql('dt')}, CASE WHEN sv <> '' THEN sv END, CASE WHEN description IS NOT NULL AND description <> '' "
            f"AND NOT contains(lower(dt), lower(description)) THEN {_clean_sql('description')} END) || extension AS path FROM z")


@query("name_hierarchical", _hier_sql())
def name_hierarchical(spark, sf_dir):
    """T8 over corporate fields (X11) with quarters from C14 (fallback given)."""
    c = cat(spark, sf_dir).select("file_id", "extension", X.x_corporate(standardise=False).alias("fields"))
    c = c.withColumn("quarter", C.quarter_of(F.col("fields.date"), "2000-Q1"))
    return c.select("file_id", N.t_hierarchical().alias("path"))
