"""Queries over the generated file catalog: F1-F7, X1-X10, C1-C17, T1-T7, A1-A3."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import inputs
from ..functions import convert as C
from ..functions import extract as X
from ..functions import filters as FL
from ..functions import naming as N
from ..functions.template import section_template
from ..functions.text import title_case
from ..plans import rename as R
from ..plans.spec import Pipeline, register_step
from .registry import query

CAT = inputs.catalog_cte()


def cat(spark, sf_dir):
    return inputs.catalog(spark, sf_dir)


# ---------------------------------------------------------------- filters

@query("filter_pattern", f"WITH {CAT} SELECT file_id, file_name FROM catalog "
       "WHERE file_name GLOB '*_report_*' AND NOT (file_name GLOB '*_draft_*')")
def filter_pattern(spark, sf_dir):
    return cat(spark, sf_dir).filter(FL.f_pattern("*_report_*", "*_draft_*")).select("file_id", "file_name")


@query("filter_type", f"WITH {CAT} SELECT file_id, extension FROM catalog "
       "WHERE lower(ltrim(extension, '.')) IN ('pdf', 'docx')")
def filter_type(spark, sf_dir):
    return cat(spark, sf_dir).filter(FL.f_file_type("pdf", ".DOCX")).select("file_id", "extension")


@query("filter_size", f"WITH {CAT} SELECT file_id, size FROM catalog WHERE size BETWEEN 102400 AND 307200")
def filter_size(spark, sf_dir):
    return cat(spark, sf_dir).filter(FL.f_file_size("100KB", "300KB")).select("file_id", "size")


@query("filter_length", f"WITH {CAT} SELECT file_id, base_name FROM catalog WHERE length(base_name) BETWEEN 20 AND 40")
def filter_length(spark, sf_dir):
    return cat(spark, sf_dir).filter(FL.f_name_length(20, 40)).select("file_id", "base_name")


@query("filter_modified", f"WITH {CAT} SELECT file_id, strftime(modified, '%Y-%m-%d') AS day FROM catalog "
       "WHERE modified >= TIMESTAMP '1998-01-01' OR CAST(modified AS DATE) = DATE '1996-03-15'")
def filter_modified(spark, sf_dir):
    p = FL.f_date_modified(">=", "1998-01-01") | FL.f_date_modified("==", "1996-03-15")
    return cat(spark, sf_dir).filter(p).select("file_id", F.date_format("modified", "yyyy-MM-dd").alias("day"))


@query("filter_all", f"WITH {CAT} SELECT file_id, file_name FROM catalog "
       "WHERE lower(ltrim(extension, '.')) IN ('pdf', 'jpg') AND NOT (file_name GLOB 'IMG_*') AND size >= 200000")
def filter_all(spark, sf_dir):
    preds = [FL.f_file_type("pdf,jpg"), FL.invert(FL.f_pattern("IMG_*")), FL.f_file_size(200000)]
    return FL.apply_filters(cat(spark, sf_dir), preds).select("file_id", "file_name")


# ---------------------------------------------------------------- extraction

SPLIT5 = ("dept", "type", "status", "date", "seq")


@query("extract_split", f"WITH {CAT} SELECT file_id, split_part(base_name, '_', 1) AS dept, "
       "split_part(base_name, '_', 2) AS type, split_part(base_name, '_', 3) AS status, "
       "split_part(base_name, '_', 4) AS date, split_part(base_name, '_', 5) AS seq FROM catalog")
def extract_split(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.x_split("_", *SPLIT5).alias("f")).select("file_id", "f.*")


RX_NAMED = r"(?P<dept>[A-Za-z]+)_(?P<type>[a-z]+)_(?P<status>[a-z]+)_(?P<date>\d{8})"
RX_DUCK = r"([A-Za-z]+)_([a-z]+)_([a-z]+)_(\d{8})"


@query("extract_regex", f"WITH {CAT} SELECT file_id, " + ", ".join(
    f"CASE WHEN regexp_matches(base_name, '{RX_DUCK}') THEN regexp_extract(base_name, '{RX_DUCK}', {i}) END AS {n}"
    for i, n in enumerate(["dept", "type", "status", "date"], 1)) + " FROM catalog")
def extract_regex(spark, sf_dir):
    f = X.x_regex(RX_NAMED)
    return cat(spark, sf_dir).select("file_id", f.alias("f")).select(
        "file_id", *[F.col("f").getField(n).alias(n) for n in ("dept", "type", "status", "date")])


RX_NUM = r"Invoice_(\d+)_([A-Za-z]+)"


@query("extract_regex_numbered", f"WITH {CAT} SELECT file_id, "
       f"CASE WHEN regexp_matches(base_name, '{RX_NUM}') THEN regexp_extract(base_name, '{RX_NUM}', 1) END AS number, "
       f"CASE WHEN regexp_matches(base_name, '{RX_NUM}') THEN regexp_extract(base_name, '{RX_NUM}', 2) END AS company "
       "FROM catalog")
def extract_regex_numbered(spark, sf_dir):
    f = X.x_regex(RX_NUM, field1="number", field2="company", field7="ignored")
    return cat(spark, sf_dir).select("file_id", f.getField("number").alias("number"), f.getField("company").alias("company"))


RX_OPT = r"^([A-Za-z]+)_(?:(\d+)_)?([A-Za-z]+)"


@query("extract_regex_optional", f"WITH {CAT} SELECT file_id, regexp_matches(base_name, '{RX_OPT}') AS matched, "
       f"CASE WHEN regexp_matches(base_name, '^[A-Za-z]+_\\d+_[A-Za-z]+') THEN regexp_extract(base_name, '{RX_OPT}', 2) END AS number, "
       f"CASE WHEN regexp_matches(base_name, '{RX_OPT}') THEN regexp_extract(base_name, '{RX_OPT}', 3) END AS word FROM catalog")
def extract_regex_optional(spark, sf_dir):
    """A group that takes no part in the match is NULL."""
    f = X.x_regex(RX_OPT, field2="number", field3="word")
    return cat(spark, sf_dir).select("file_id", f.alias("f")).select(
        "file_id", F.col("f").isNotNull().alias("matched"), F.col("f.number").alias("number"), F.col("f.word").alias("word"))


@query("extract_position", f"WITH {CAT} SELECT file_id, substr(base_name, 1, 2) AS d2, "
       "CASE WHEN length(base_name) > 4 THEN substr(base_name, 5, 1) ELSE '' END AS c, "
       "CASE WHEN length(base_name) > 30 THEN substr(base_name, 31, 11) ELSE '' END AS far FROM catalog")
def extract_position(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.x_position("0-1:d2", "4:c", "30-40:far").alias("f")).select("file_id", "f.*")


@query("extract_metadata", f"WITH {CAT} SELECT file_id, strftime(created, '%Y-%m-%d') AS created, "
       "strftime(modified, '%Y-%m-%d') AS modified, CAST(CAST(floor(size / 1024) AS BIGINT) AS VARCHAR) AS size FROM catalog")
def extract_metadata(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.x_metadata().alias("f")).select("file_id", "f.*")


@query("extract_business", f"WITH {CAT} SELECT file_id, "
       "CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 1) ELSE 'misc' END AS dept, "
       "CASE WHEN len(string_split(base_name, '_')) >= 2 THEN split_part(base_name, '_', 2) ELSE base_name END AS type, "
       "CASE WHEN len(string_split(base_name, '_')) >= 3 THEN split_part(base_name, '_', 3) ELSE 'unknown' END AS date "
       "FROM catalog")
def extract_business(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.x_business_doc().alias("f")).select("file_id", "f.*")


INV = [p for p in X.INVOICE_PATTERNS]


@query("extract_invoice", f"WITH {CAT} SELECT file_id, "
       f"CASE WHEN regexp_matches(base_name, '{INV[0]}') OR regexp_matches(base_name, '{INV[1]}') "
       f"OR regexp_matches(base_name, '{INV[2]}') THEN 'Invoice' ELSE 'Document' END AS type, "
       f"CASE WHEN regexp_matches(base_name, '{INV[0]}') THEN regexp_extract(base_name, '{INV[0]}', 1) "
       f"WHEN regexp_matches(base_name, '{INV[1]}') THEN regexp_extract(base_name, '{INV[1]}', 1) "
       f"WHEN regexp_matches(base_name, '{INV[2]}') THEN regexp_extract(base_name, '{INV[2]}', 1) ELSE 'unknown' END AS number, "
       f"CASE WHEN regexp_matches(base_name, '{INV[0]}') THEN regexp_extract(base_name, '{INV[0]}', 2) "
       f"WHEN regexp_matches(base_name, '{INV[1]}') THEN regexp_extract(base_name, '{INV[1]}', 2) "
       f"WHEN regexp_matches(base_name, '{INV[2]}') THEN regexp_extract(base_name, '{INV[2]}', 2) ELSE 'unknown' END AS company, "
       f"CASE WHEN regexp_matches(base_name, '{INV[0]}') THEN coalesce(nullif(regexp_extract(base_name, '{INV[0]}', 3), ''), 'unknown') "
       f"ELSE 'unknown' END AS date FROM catalog")
def extract_invoice(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.x_invoice().alias("f")).select("file_id", "f.*")


@query("extract_photo", f"""WITH {CAT}, p AS (
  SELECT file_id, base_name, modified, regexp_extract(base_name, '(\\d{{8}})', 1) AS d8,
         regexp_extract(base_name, '(\\d{{6}})', 1) AS t6 FROM catalog),
q AS (SELECT *, CASE WHEN d8 <> '' THEN try_strptime(d8, '%Y%m%d') ELSE modified END AS dday,
         CASE WHEN t6 <> '' THEN try_strptime('19700101' || t6, '%Y%m%d%H%M%S') END AS tt FROM p)
SELECT file_id,
  CASE WHEN d8 <> '' AND dday IS NULL THEN 'unknown' ELSE coalesce(strftime(dday, '%Y-%m-%d'), 'unknown') END AS date,
  strftime(dday, '%Y') AS year, strftime(dday, '%m') AS month, strftime(dday, '%d') AS day,
  CASE WHEN tt IS NULL THEN 'unknown' ELSE strftime(tt, '%H-%M-%S') END AS time,
  strftime(tt, '%H') AS hour,
  CASE WHEN regexp_matches(base_name, '(?i)^(IMG|DSC|DCIM|P\\d+)_') THEN regexp_extract(base_name, '(?i)^(IMG|DSC|DCIM|P\\d+)_', 1)
       WHEN regexp_matches(base_name, '(?i)(iPhone|Samsung|Pixel|Canon|Nikon|Sony)')
       THEN regexp_extract(base_name, '(?i)(iPhone|Samsung|Pixel|Canon|Nikon|Sony)', 1) ELSE 'unknown' END AS device,
  CASE WHEN contains(upper(base_name), 'IMG') THEN 'Photo' WHEN contains(upper(base_name), 'VID') THEN 'Video'
       WHEN contains(upper(base_name), 'SCR') OR contains(base_name, 'Screenshot') THEN 'Screenshot' ELSE 'Media' END AS type
FROM q""")
def extract_photo(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.x_photo().alias("f")).select("file_id", "f.*")


KEYWORD_RULES = {"analysis": ["report", "analysis"], "legal": ["contract", "policy"], "media": ["img", "jpg"],
                 "billing": ["invoice"]}


def _kw_sql(col):
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({col}), '{k}')" for k in kws) + f" THEN '{label}'"
        for label, kws in KEYWORD_RULES.items())
    return f"CASE {arms} ELSE 'other' END"


@query("classify_keywords", f"WITH {CAT} SELECT file_id, {_kw_sql('file_name')} AS label FROM catalog")
def classify_keywords(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", X.classify_keywords(KEYWORD_RULES, "other", "file_name").alias("label"))


# ---------------------------------------------------------------- conversion

def _split(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", "base_name", "extension", X.x_split("_", *SPLIT5).alias("fields"))


PAD_SQL = """CASE WHEN {v} IS NULL OR {v} = '' THEN {v}
  WHEN regexp_replace({v}, '[^0-9]', '', 'g') = '' THEN {v}
  WHEN instr({v}, regexp_replace({v}, '[^0-9]', '', 'g')) > 0 THEN
    substr({v}, 1, instr({v}, regexp_replace({v}, '[^0-9]', '', 'g')) - 1)
    || CASE WHEN length(regexp_replace({v}, '[^0-9]', '', 'g')) < {w} THEN lpad(regexp_replace({v}, '[^0-9]', '', 'g'), {w}, '0')
            ELSE regexp_replace({v}, '[^0-9]', '', 'g') END
    || substr({v}, instr({v}, regexp_replace({v}, '[^0-9]', '', 'g')) + length(regexp_replace({v}, '[^0-9]', '', 'g')))
  ELSE {v} END"""


@query("convert_pad", f"WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 2) AS type, "
       "split_part(base_name, '_', 4) AS date, split_part(base_name, '_', 5) AS seq FROM catalog) "
       f"SELECT file_id, {PAD_SQL.format(v='type', w=8)} AS type, {PAD_SQL.format(v='date', w=3)} AS date, "
       f"{PAD_SQL.format(v='seq', w=6)} AS seq FROM s")
def convert_pad(spark, sf_dir):
    f = F.col("fields")
    f = C.c_pad_numbers(f, "type", 8)
    f = C.c_pad_numbers(f, "date", 3)
    f = C.c_pad_numbers(f, "seq", 6)
    return _split(spark, sf_dir).select("file_id", f.alias("f")).select("file_id", "f.type", "f.date", "f.seq")


@query("convert_date", f"WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 4) AS date, "
       "split_part(base_name, '_', 2) AS type FROM catalog) "
       "SELECT file_id, CASE WHEN date = '' THEN date ELSE coalesce(strftime(try_strptime(date, '%Y%m%d'), '%d-%b-%Y'), date) END AS date, "
       "CASE WHEN type = '' THEN type ELSE coalesce(strftime(try_strptime(type, '%Y%m%d'), '%Y/%m/%d'), type) END AS type FROM s")
def convert_date(spark, sf_dir):
    f = C.c_date_format("fields", "date", "%Y%m%d", "%d-%b-%Y")
    f = C.c_date_format(f, "type", "%Y%m%d", "%Y/%m/%d")
    return _split(spark, sf_dir).select("file_id", f.alias("f")).select("file_id", "f.date", "f.type")


def _title_sql(v):
    return (f"array_to_string(list_transform(regexp_extract_all({v}, '(\\p{{L}}+|[^\\p{{L}}]+)'), "
            f"lambda x: CASE WHEN regexp_matches(x, '^\\p{{L}}') THEN upper(x[1]) || lower(x[2:]) ELSE x END), '')")


@query("convert_case", f"WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 1) AS dept, "
       "split_part(base_name, '_', 2) AS type, split_part(base_name, '_', 3) AS status, base_name FROM catalog) "
       "SELECT file_id, CASE WHEN dept = '' THEN dept ELSE upper(dept) END AS dept, "
       f"CASE WHEN type = '' THEN type ELSE {_title_sql('type')} END AS type, "
       "CASE WHEN status = '' THEN status ELSE upper(substr(status, 1, 1)) || lower(substr(status, 2)) END AS status, "
       f"{_title_sql('base_name')} AS title_name FROM s")
def convert_case(spark, sf_dir):
    f = C.c_case("fields", "dept", "upper")
    f = C.c_case(f, "type", "title")
    f = C.c_case(f, "status", "capitalize")
    return _split(spark, sf_dir).select("file_id", f.alias("f"), title_case("base_name").alias("title_name")) \
        .select("file_id", "f.dept", "f.type", "f.status", "title_name")


def _map_sql(v, mapping):
    arms = " ".join(f"WHEN upper({v}) = '{k}' THEN '{val}'" for k, val in mapping.items())
    return f"CASE {arms} ELSE {_title_sql(v)} END"


@query("standardise_codes", f"WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 1) AS dept, "
       "split_part(base_name, '_', 2) AS type FROM catalog) "
       f"SELECT file_id, {_map_sql('dept', C.DEPT_NAMES)} AS dept_full, {_map_sql('type', C.TYPE_NAMES)} AS type_formatted FROM s")
def standardise_codes(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.select("file_id", C.map_values(F.col("fields.dept"), C.DEPT_NAMES).alias("dept_full"),
                    C.map_values(F.col("fields.type"), C.TYPE_NAMES).alias("type_formatted"))


@query("clean_company", f"""WITH {CAT}, s AS (SELECT file_id,
  trim(regexp_replace(regexp_replace(split_part(base_name, '_', 3), '(?i)\\b(inc|ltd|llc|corp|co)\\b', '', 'g'),
       '[^\\w\\s-]', '', 'g')) AS c FROM catalog)
SELECT file_id, {_title_sql("regexp_replace(c, '\\s+', '-', 'g')")} AS company_clean FROM s""")
def clean_company(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.select("file_id", C.clean_company(F.col("fields.status")).alias("company_clean"))


@query("client_tier", f"WITH {CAT} SELECT file_id, CASE "
       "WHEN contains(lower(base_name), 'corp') OR contains(lower(base_name), 'global') OR contains(lower(base_name), 'mega') "
       "OR contains(lower(base_name), 'enterprise') THEN 'enterprise' "
       "WHEN contains(lower(base_name), 'startup') OR contains(lower(base_name), 'tech') OR contains(lower(base_name), 'labs') "
       "THEN 'startup' ELSE 'standard' END AS tier FROM catalog")
def client_tier(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", C.client_tier("base_name").alias("tier"))


@query("quarter_of", f"""WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 4) AS d FROM catalog)
SELECT file_id, CASE
  WHEN length(d) = 8 AND TRY_CAST(substr(d, 1, 4) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(d, 5, 2) AS INTEGER) IS NOT NULL
    THEN CAST(TRY_CAST(substr(d, 1, 4) AS INTEGER) AS VARCHAR) || '-Q' || CAST(CAST(floor((TRY_CAST(substr(d, 5, 2) AS INTEGER) - 1) / 3) AS INTEGER) + 1 AS VARCHAR)
  WHEN length(d) = 6 AND TRY_CAST(substr(d, 1, 2) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(d, 5, 2) AS INTEGER) IS NOT NULL
    THEN CAST(2000 + TRY_CAST(substr(d, 5, 2) AS INTEGER) AS VARCHAR) || '-Q' || CAST(CAST(floor((TRY_CAST(substr(d, 1, 2) AS INTEGER) - 1) / 3) AS INTEGER) + 1 AS VARCHAR)
  ELSE 'undated' END AS quarter FROM s""")
def quarter_of(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.select("file_id", C.quarter_of(F.col("fields.date"), "undated").alias("quarter"))


def _classification_sql():
    return ("split_part(base_name, '_', 1) || '-' || " + _title_sql("split_part(base_name, '_', 2)"))


@query("retention", f"WITH {CAT}, s AS (SELECT file_id, {_classification_sql()} AS cls FROM catalog) "
       "SELECT file_id, cls, CAST(CASE cls " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.RETENTION_YEARS.items())
       + " ELSE 3 END AS BIGINT) AS retention_years FROM s")
def retention(spark, sf_dir):
    s = _split(spark, sf_dir)
    cls = F.concat_ws("-", F.col("fields.dept"), title_case(F.col("fields.type")))
    return s.select("file_id", cls.alias("cls"), C.retention_years(cls).alias("retention_years"))


@query("confidentiality", f"WITH {CAT}, s AS (SELECT file_id, lower(file_name) AS low, {_classification_sql()} AS cls FROM catalog) "
       "SELECT file_id, CASE WHEN contains(low, 'confidential') THEN 'CONFIDENTIAL' WHEN contains(low, 'internal') THEN 'INTERNAL' "
       "WHEN contains(low, 'public') THEN 'PUBLIC' WHEN starts_with(cls, 'Legal-') THEN 'CONFIDENTIAL' "
       "WHEN starts_with(cls, 'Finance-') THEN 'RESTRICTED' ELSE 'INTERNAL' END AS confidentiality FROM s")
def confidentiality(spark, sf_dir):
    s = cat(spark, sf_dir).select("file_id", "file_name", X.x_split("_", *SPLIT5).alias("fields"))
    cls = F.concat_ws("-", F.col("fields.dept"), title_case(F.col("fields.type")))
    return s.select("file_id", C.confidentiality(cls, "file_name").alias("confidentiality"))


# ---------------------------------------------------------------- naming

@query("name_section", f"WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 1) AS a, split_part(base_name, '_', 2) AS b, "
       "split_part(base_name, '_', 3) AS c FROM catalog) SELECT file_id, CASE WHEN a = '' THEN '' ELSE 'from ' || a || ':' END || b || "
       "'{c=' || c || '}' AS new_base FROM s")
def name_section(spark, sf_dir):
    """A section template over extracted fields."""
    c = cat(spark, sf_dir).select("file_id", "base_name", X.x_split("_", "a", "b", "c").alias("fields"))
    c = c.withColumn("fields", F.col("fields").withField("a", F.when(F.col("fields.a") != "", F.col("fields.a"))))
    out = section_template("{{from ;a;:}}{{b}}{{\\{c=;c;\\}}}", "fields", c.schema["fields"].dataType)
    return c.select("file_id", out.alias("new_base"))


@query("custom_step", f"WITH {CAT} SELECT file_name AS old_name, reverse(base_name) || extension AS new_name FROM catalog "
       "WHERE size % 2 = 0 AND reverse(base_name) <> base_name")
def custom_step(spark, sf_dir):
    """A custom filter and a custom one-step renamer in a spec."""
    register_step("filter", "even-size", lambda: F.col("size") % 2 == 0)
    register_step("all_in_one", "backwards", lambda df: F.reverse("base_name"))
    spec = {"pipeline": {"filters": [{"name": "even-size"}], "all_in_one": {"name": "backwards"}}}
    return R.plan_changes(Pipeline.from_dict(spec).plan(cat(spark, sf_dir))).select("old_name", "new_name")


@query("name_template", f"WITH {CAT}, s AS (SELECT file_id, split_part(base_name, '_', 1) AS dept, "
       "split_part(base_name, '_', 2) AS type, split_part(base_name, '_', 3) AS status, "
       "split_part(base_name, '_', 4) AS date FROM catalog) "
       "SELECT file_id, dept || '-' || type || '.' || date AS name_full, "
       "CASE WHEN dept <> '' THEN dept ELSE '{dept}' END || '_{missing}_' || "
       "CASE WHEN status <> '' THEN status ELSE '{status}' END AS name_partial FROM s")
def name_template(spark, sf_dir):
    s = cat(spark, sf_dir).select("file_id", "base_name", X.x_split("_", "dept", "type", "status", "date").alias("fields"))
    ft = s.schema["fields"].dataType
    return s.select("file_id", N.t_template("{dept}-{type}.{date}", fields_type=ft).alias("name_full"),
                    N.t_template("{dept}_{missing}_{status}", fields_type=ft).alias("name_partial"))


@query("name_join", f"WITH {CAT}, s AS (SELECT file_id, base_name, split_part(base_name, '_', 1) AS dept, "
       "split_part(base_name, '_', 2) AS type, split_part(base_name, '_', 3) AS status, "
       "split_part(base_name, '_', 4) AS date, split_part(base_name, '_', 5) AS seq FROM catalog) "
       "SELECT file_id, coalesce(nullif(concat_ws('-', nullif(dept, ''), nullif(status, ''), nullif(seq, '')), ''), base_name) AS joined, "
       "coalesce(nullif(concat_ws('_', nullif(dept, ''), nullif(type, ''), nullif(status, ''), nullif(date, ''), nullif(seq, '')), ''), base_name) AS joined_all FROM s")
def name_join(spark, sf_dir):
    s = _split(spark, sf_dir)
    ft = s.schema["fields"].dataType
    return s.select("file_id", N.t_join("dept", "status", "seq", sep="-", fields_type=ft).alias("joined"),
                    N.t_join(fields_type=ft).alias("joined_all"))


@query("name_hash_sequence", f"WITH {CAT} SELECT file_id, base_name || '_' || "
       "lpad(CAST(CAST('0x' || substr(md5(base_name), 1, 4) AS INTEGER) % 1000 AS VARCHAR), 3, '0') AS name FROM catalog")
def name_hash_sequence(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", N.t_hash_sequence("base_name", "{name}_{seq:03d}").alias("name"))


@query("rename_replace", f"WITH {CAT} SELECT file_id, replace(replace(base_name, '_', '-'), 'report', 'rpt') AS new_base FROM catalog")
def rename_replace(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", N.a_replace("_", "-", "report", "rpt").alias("new_base"))


@query("rename_case", f"WITH {CAT} SELECT file_id, lower(base_name) AS lower_name, upper(base_name) AS upper_name FROM catalog")
def rename_case(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", N.a_lower().alias("lower_name"), N.a_upper().alias("upper_name"))


@query("rename_clean", f"""WITH {CAT}, s AS (SELECT file_id, base_name,
  trim(regexp_replace(regexp_replace(replace(base_name, ' ', '_'), '[^\\w\\-]', '_', 'g'), '_+', '_', 'g'), '_') AS c FROM catalog)
SELECT file_id, CASE WHEN c = '' THEN base_name ELSE c END AS clean_name FROM s""")
def rename_clean(spark, sf_dir):
    return cat(spark, sf_dir).select("file_id", N.a_clean("_").alias("clean_name"))
