"""T1-T8 name formatting and A1-A8 one-step renamers (Column -> string Column)."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col_of

STEM = "base_name"


def _field_names(fields_type: T.DataType | None) -> list[str]:
    return fields_type.fieldNames() if isinstance(fields_type, T.StructType) else []


def _str(v: Column) -> Column:
    # Python str() of a missing value prints 'None'
    return F.coalesce(v.cast("string"), F.lit("None"))


def t_template(fmt: str, fields: str | Column = "fields", fields_type: T.DataType | None = None,
               stem: str | Column = STEM, present: Column | None = None) -> Column:
    """``{field}`` template. No fields -> stem.

    If every placeholder names a field, values are substituted. Otherwise
    (fallback) only present *non-empty* values are substituted and the other
    placeholders stay verbatim. ``present`` (array of names) are the fields a
    row has, where that differs by row; without it a row has all of the type's.
    """
    if not fmt:
        raise ValueError("a template needs a text")
    s = col_of(fields)
    names = _field_names(fields_type)
    pieces = list(string.Formatter().parse(fmt))
    wanted = [f for _, f, _, _ in pieces if f is not None]
    complete = all(f in names for f in wanted)
    whole = F.lit(complete)
    if complete and present is not None and wanted:
        whole = F.forall(F.array(*[F.lit(f) for f in dict.fromkeys(wanted)]), lambda n: F.array_contains(present, n))
    parts = []
    for literal, field, spec, conv in pieces:
        if literal:
            parts.append(F.lit(literal.replace("{{", "{").replace("}}", "}")))
        if field is None:
            continue
        if spec or conv:
            raise ValueError("format specs and conversions are not supported in {field} templates")
        raw = F.lit("{" + field + "}")
        if field in names:
            v = s.getField(field)
            filled = F.when(v.isNotNull() & (v.cast("string") != ""), v.cast("string")).otherwise(raw)
            if complete:
                parts.append(_str(v) if present is None else F.when(whole, _str(v)).otherwise(filled))
            else:
                parts.append(filled)
        else:
            parts.append(raw)
    out = F.concat(*parts) if parts else F.lit("")
    return F.when(s.isNull(), col_of(stem)).otherwise(out)


def t_join(*names: str, sep: str = "_", fields: str | Column = "fields", fields_type: T.DataType | None = None,
           stem: str | Column = STEM) -> Column:
    """Join named (or all) non-empty fields with ``sep``; none -> stem."""
    s = col_of(fields)
    present = _field_names(fields_type)
    use = [n for n in names if n in present] if names else present
    vals = F.array(*[s.getField(n).cast("string") for n in use]) if use else F.array().cast("array<string>")
    kept = F.filter(vals, lambda x: x.isNotNull() & (x != ""))
    return F.when(s.isNull() | (F.size(kept) == 0), col_of(stem)).otherwise(F.array_join(kept, sep))


def t_hash_sequence(name: str | Column, pattern: str = "{name}_{seq:03d}") -> Column:
    """seq = int(md5(name)[:4], 16) % 1000, formatted into ``pattern``.

    ``pattern`` uses ``{name}`` and ``{seq}`` / ``{seq:0Nd}``.
    """
    c = col_of(name)
    seq = F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("bigint") % 1000
    parts = []
    for literal, field, spec, _ in string.Formatter().parse(pattern):
        if literal:
            parts.append(F.lit(literal))
        if field == "name":
            parts.append(c)
        elif field == "seq":
            m = re.fullmatch(r"0?(\d*)d?", spec or "")
            width = int(m.group(1)) if m and m.group(1) else 0
            parts.append(F.format_string(f"%0{width}d" if width else "%d", seq))
        elif field is not None:
            raise ValueError(f"unknown placeholder {field!r}")
    return F.concat(*parts)


def a_replace(*pairs: str, col: str | Column = STEM) -> Column:
    """A1: literal find/replace pairs applied in order."""
    if len(pairs) % 2:
        raise ValueError("give what to find and what to put there, in pairs")
    c = col_of(col)
    for i in range(0, len(pairs), 2):
        if pairs[i] == "":
            # Python inserts the replacement between every character for an empty search string
            c = F.concat(F.lit(pairs[i + 1]),
                         F.array_join(F.split(c, ""), pairs[i + 1]), F.lit(pairs[i + 1])) if pairs[i + 1] else c
        else:
            c = F.replace(c, F.lit(pairs[i]), F.lit(pairs[i + 1]))
    return c


def a_lower(col: str | Column = STEM) -> Column:
    """A2."""
    return F.lower(col_of(col))


def a_upper(col: str | Column = STEM) -> Column:
    """A2."""
    return F.upper(col_of(col))


def a_clean(repl: str = "_", col: str | Column = STEM) -> Column:
    """A3: spaces and non-word characters -> ``repl``, collapse runs, trim; empty -> original."""
    c = col_of(col)
    x = F.replace(c, F.lit(" "), F.lit(repl))
    x = F.regexp_replace(x, r"(?U)[^\w\-]", repl.replace("\\", "\\\\").replace("$", "\\$"))
    if repl:
        q = re.escape(repl)
        x = F.regexp_replace(x, f"(?:{q})+", repl.replace("\\", "\\\\").replace("$", "\\$"))
        chars = "".join("\\" + ch if ch in "\\]^-[" else ch for ch in set(repl))
        x = F.regexp_replace(x, f"^[{chars}]+|[{chars}]+$", "")
    return F.when(x == "", c).otherwise(x)


def new_name(base: str | Column, ext: str | Column = "extension") -> Column:
    """Append the original extension unless the new base already ends with it."""
    b, e = col_of(base), col_of(ext)
    return F.when(F.endswith(b, e), b).otherwise(F.concat(b, e))


def limit_length(c: str | Column, n: int) -> Column:
    """Cut to ``n`` characters with '...' (C12 rule)."""
    c = col_of(c)
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n - 3), F.lit("..."))).otherwise(c)


# --- fixed values: one-step business renamer maps ----------------------------
A_DEPT_NAMES = {"HR": "Human-Resources", "IT": "Information-Technology", "FIN": "Finance", "LEGAL": "Legal",
                "OPS": "Operations", "SALES": "Sales", "MKT": "Marketing"}
A_TYPE_NAMES = {"POLICY": "Policy", "PROCEDURE": "Procedure", "REPORT": "Report", "MEETING": "Meeting-Notes",
                "CONTRACT": "Contract", "INVOICE": "Invoice", "PROPOSAL": "Proposal"}


def a_business(col: str | Column = STEM, department_mapping: bool = True, include_year: bool = False) -> Column:
    """A4: split by '_' -> dept/type/date, map codes (else title case), ISO date for 8-digit dates."""
    from .convert import map_values
    from .extract import x_business_doc
    f = x_business_doc(col)
    dept = map_values(f.getField("dept"), A_DEPT_NAMES) if department_mapping else f.getField("dept")
    typ = map_values(f.getField("type"), A_TYPE_NAMES)
    raw = f.getField("date")
    iso = F.date_format(F.try_to_timestamp(raw, F.lit("yyyyMMdd")), "yyyy-MM-dd")
    date = F.when((raw != "unknown") & (F.char_length(raw) == 8), F.coalesce(iso, raw)).otherwise(raw)
    known = date != "unknown"
    out = F.when(known, F.concat_ws("_", dept, typ, date)).otherwise(F.concat_ws("_", dept, typ))
    if include_year:
        out = F.when(known, F.concat_ws("_", F.substring(date, 1, 4), dept, typ, date)).otherwise(out)
    return out


def a_invoices(col: str | Column = STEM, company_prefix: bool = True, number_padding: int = 6) -> Column:
    """A5: invoice cascade, cleaned company, padded number, optional date."""
    from .convert import clean_company
    from .extract import x_invoice
    f = x_invoice(col)
    company, number, date = f.getField("company"), f.getField("number"), f.getField("date")
    comp = F.when(company != "unknown", clean_company(company)).otherwise(F.lit("Unknown-Company"))
    as_int = F.trim(number).try_cast("bigint")
    num = (F.when((number != "unknown") & as_int.isNotNull(), F.format_string(f"%0{int(number_padding)}d", as_int))
           .when(number != "unknown", number).otherwise(F.lit("0" * int(number_padding))))
    dated = date != "unknown"
    if company_prefix:
        return F.when(dated, F.concat_ws("_", comp, F.lit("Invoice"), num, date)).otherwise(
            F.concat_ws("_", comp, F.lit("Invoice"), num))
    return F.when(dated, F.concat_ws("_", F.lit("Invoice"), num, comp, date)).otherwise(
        F.concat_ws("_", F.lit("Invoice"), num, comp))


# --- fixed values: media categories by extension -----------------------------
IMAGE_EXTS = [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp"]
VIDEO_EXTS = [".mp4", ".avi", ".mov", ".mkv", ".wmv", ".flv", ".webm"]
AUDIO_EXTS = [".mp3", ".wav", ".flac", ".aac", ".ogg", ".m4a"]


def a_media(col: str | Column = STEM, ext: str | Column = "extension", categorize_by_type: bool = True,
            include_resolution: bool = False, max_length: int = 50) -> Column:
    """Date (8 digits), time (6 digits), media type by extension, cleaned residual name, length cap."""
    from .text import title_case
    c, e = col_of(col), F.lower(col_of(ext))
    kind = (F.when(e.isin(*IMAGE_EXTS), F.lit("Image")).when(e.isin(*VIDEO_EXTS), F.lit("Video"))
            .when(e.isin(*AUDIO_EXTS), F.lit("Audio")).otherwise(F.lit("Unknown")))
    date = F.nullif(F.regexp_extract(c, r"(\d{8})", 1), F.lit(""))
    time = F.nullif(F.regexp_extract(c, r"(\d{6})", 1), F.lit(""))
    rest = F.regexp_replace(F.regexp_replace(c, r"[\d_\-.]+", ""), r"(?U)[^\w\s]", "")
    rest = F.regexp_replace(rest, r"(?U)^\s+|\s+$", "")
    parts = [date, time] + ([kind] if categorize_by_type else []) + ([F.lit("HD")] if include_resolution else [])
    parts.append(F.when(F.char_length(rest) > 3, title_case(rest)))
    name = F.concat_ws("_", *parts)  # NULL parts are skipped
    name = F.when(name == "", c).otherwise(name)
    return limit_length(name, max_length)


def t_creative(fields: str | Column = "fields", fields_type: T.DataType | None = None, stem: str | Column = STEM) -> Column:
    """Artist (specials removed, spaces -> '_'), medium (or type, lower), digits-x dimensions, date."""
    s = col_of(fields)
    names = _field_names(fields_type)
    get = lambda n, default: s.getField(n) if n in names else F.lit(default)
    artist = F.replace(F.regexp_replace(get("artist", "Unknown"), r"(?U)[^\w\s-]", ""), F.lit(" "), F.lit("_"))
    medium = get("medium", None) if "medium" in names else get("type", "artwork")
    medium = F.lower(F.replace(medium, F.lit(" "), F.lit("_")))
    dims = get("dimensions", "")
    clean = F.regexp_replace(F.lower(dims), r"[^\dx]", "")
    dims = F.when(clean != "", clean).otherwise(dims)
    date = get("date", "")
    out = F.concat_ws("_", artist, medium, F.when(F.coalesce(dims, F.lit("")) != "", dims),
                      F.when(F.coalesce(date, F.lit("")) != "", date))
    return F.when(s.isNull(), col_of(stem)).otherwise(out)


PROJECT_STATUSES = ["draft", "review", "final", "archive"]


def t_project(fields: str | Column = "fields", fields_type: T.DataType | None = None, stem: str | Column = STEM,
              project_prefix: str = "", include_version: bool = True) -> Column:
    """T5: [prefix] project(' '->'-') [v-version] [Status] [first 8 digits of the date when >= 6 digits]."""
    from .text import title_case
    s = col_of(fields)
    names = _field_names(fields_type)
    get = lambda n, default: s.getField(n) if n in names else F.lit(default)
    parts = [F.lit(project_prefix)] if project_prefix else []
    parts.append(F.replace(get("project", "Project"), F.lit(" "), F.lit("-")))
    if include_version:
        v = get("version", "")
        parts.append(F.when(F.coalesce(v, F.lit("")) == "", F.lit(None))
                     .when(F.startswith(v, F.lit("v")), v).otherwise(F.concat(F.lit("v"), v)))
    st = F.lower(get("status", ""))
    parts.append(F.when(st.isin(*PROJECT_STATUSES), title_case(st)))
    digits = F.regexp_replace(F.coalesce(get("date", ""), F.lit("")), r"[^\d]", "")
    parts.append(F.when(F.char_length(digits) >= 6, F.substring(digits, 1, 8)))
    return F.when(s.isNull(), col_of(stem)).otherwise(F.concat_ws("_", *parts))


def c_document(fields: str | Column = "fields", stem: str | Column = STEM, department_folders: bool = True,
               date_folders: bool = False, max_len: int = 50) -> Column:
    """formatted_name (type, date; dept unless foldered; length cap) and suggested_folder."""
    s = col_of(fields)
    dept, typ, date = s.getField("dept"), s.getField("type"), s.getField("date")
    known = lambda v: v.isNotNull() & (v != "") & (v != "unknown")
    comps = []
    if not department_folders:
        comps.append(F.when(known(dept), F.upper(dept)))
    comps.append(F.when(known(typ), F.replace(typ, F.lit(" "), F.lit("-"))))
    comps.append(F.when(known(date), F.replace(date, F.lit("-"), F.lit(""))))
    joined = F.concat_ws("_", *comps)
    name = F.when(joined == "", F.substring(col_of(stem), 1, max_len)).otherwise(limit_length(joined, max_len))
    folders = []
    if department_folders:
        folders.append(F.when(known(dept), F.upper(dept)))
    if date_folders:
        dash = date.contains("-")
        parts = F.split(date, "-", -1)
        folders.append(F.when(known(date) & dash, F.get(parts, 0))
                       .when(known(date) & (F.char_length(date) >= 6), F.substring(date, 1, 4)))
        folders.append(F.when(known(date) & dash, F.get(parts, 1))
                       .when(known(date) & (F.char_length(date) >= 6), F.substring(date, 5, 2)))
    folders.append(F.when(known(typ), F.replace(typ, F.lit(" "), F.lit("-"))))
    folder = F.concat_ws("/", *folders)
    folder = F.when(folder == "", F.lit("Documents")).otherwise(folder)
    return F.when(s.isNull(), F.struct(F.substring(col_of(stem), 1, max_len).alias("formatted_name"),
                                       F.lit(None).cast("string").alias("suggested_folder"))) \
        .otherwise(F.struct(name.alias("formatted_name"), folder.alias("suggested_folder")))


def a_photos(col: str | Column = STEM, modified: str | Column = "modified", organize_by_month: bool = True,
             include_device: bool = False, content_hash: str | Column | None = None) -> Column:
    """[yyyy-MM] yyyyMMdd (name date, else modification time) [hhmmss] [device] type [hash8].

    ``content_hash``: a column holding the file's md5 (see :func:`content_md5`);
    its first 8 characters are appended.
    """
    from .extract import DEVICE_NAMES, DEVICE_PREFIX
    c = col_of(col)
    d8 = F.regexp_extract(c, r"(\d{8})", 1)
    parsed = F.try_to_timestamp(d8, F.lit("yyyyMMdd"))
    day = F.when(d8 != "", parsed).otherwise(col_of(modified))
    bad = (d8 != "") & parsed.isNull()
    parts = []
    if organize_by_month:
        parts.append(F.when(~bad, F.date_format(day, "yyyy-MM")))
    parts.append(F.when(bad, d8).otherwise(F.coalesce(F.date_format(day, "yyyyMMdd"), F.lit("unknown-date"))))
    parts.append(F.nullif(F.regexp_extract(c, r"(\d{6})", 1), F.lit("")))
    if include_device:
        parts.append(F.when(c.rlike(DEVICE_PREFIX), F.regexp_extract(c, DEVICE_PREFIX, 1))
                     .when(c.rlike(DEVICE_NAMES), F.regexp_extract(c, DEVICE_NAMES, 1)).otherwise(F.lit("Camera")))
    up = F.upper(c)
    parts.append(F.when(up.contains("VID"), F.lit("Video"))
                 .when(up.contains("SCR") | c.contains("Screenshot"), F.lit("Screenshot")).otherwise(F.lit("Photo")))
    if content_hash is not None:
        parts.append(F.substring(col_of(content_hash), 1, 8))
    return F.concat_ws("_", *parts)


def content_md5(spark, root: str, recursive: bool = True):
    """(path, md5) of every file under ``root``: the hash is computed on the executors."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
            .select("path", F.md5("content").alias("md5")))


# --- fixed values: business-name standardisation (lower-case keys) -----------
T_DEPT_NAMES = {"hr": "HR", "human resources": "HR", "it": "IT", "tech": "IT", "technology": "IT", "fin": "Finance",
                "finance": "Finance", "accounting": "Finance", "sales": "Sales", "marketing": "Marketing",
                "mkt": "Marketing", "ops": "Operations", "operations": "Operations"}
T_TYPE_NAMES = {"rpt": "Report", "report": "Report", "doc": "Document", "document": "Document",
                "pres": "Presentation", "presentation": "Presentation", "memo": "Memo", "memorandum": "Memo"}


def t_business(today: str, fields: str | Column = "fields", fields_type: T.DataType | None = None,
               stem: str | Column = STEM) -> Column:
    """T4: Dept_Type_date with standardised codes; a missing date takes ``today`` (explicit, Q25)."""
    from .convert import map_values
    s = col_of(fields)
    names = _field_names(fields_type)
    get = lambda n, default: F.coalesce(s.getField(n), F.lit("None")) if n in names else F.lit(default)
    dept = map_values(F.lower(get("dept", "Unknown")), T_DEPT_NAMES, upper_key=False)
    typ = map_values(F.lower(get("type", "Document")), T_TYPE_NAMES, upper_key=False)
    raw = get("date", "")
    iso = F.date_format(F.try_to_timestamp(raw, F.lit("yyyyMMdd")), "yyyy-MM-dd")
    date = (F.when(raw == "", F.lit(today))
            .when((F.char_length(raw) == 8) & raw.rlike(r"^\d{8}$"), F.coalesce(iso, raw)).otherwise(raw))
    out = F.concat_ws("_", F.when(dept != "Unknown", dept), typ, date)
    return F.when(s.isNull(), col_of(stem)).otherwise(out)


def c_project(fields: str | Column = "fields", stem: str | Column = STEM, use_client_prefix: bool = True,
              include_status: bool = False, version_format: str = "v") -> Column:
    """C11: formatted_name (client, project, version, status, date) and suggested_folder with status subfolder."""
    from .text import title_case
    s = col_of(fields)
    client, project, version = s.getField("client"), s.getField("project"), s.getField("version")
    status, date = s.getField("status"), s.getField("date")
    known = lambda v: v.isNotNull() & (v != "") & (v != "unknown")
    parts = []
    if use_client_prefix:
        parts.append(F.when(known(client), F.replace(client, F.lit(" "), F.lit("-"))))
    parts.append(F.when(known(project), F.replace(project, F.lit(" "), F.lit("-"))).otherwise(F.lit("Project")))
    parts.append(F.when(known(version), F.concat(F.lit(version_format), version)))
    if include_status:
        parts.append(F.when(known(status), title_case(status)))
    parts.append(F.when(known(date), F.replace(F.replace(date, F.lit("-"), F.lit("")), F.lit("_"), F.lit(""))))
    folder = F.concat_ws("/", F.when(known(client), client), F.when(known(project), project))
    folder = F.when(folder == "", F.lit("Projects")).otherwise(folder)
    sub = (F.when(status == "archive", F.lit("/Archive")).when(status == "final", F.lit("/Final"))
           .when(status == "draft", F.lit("/Work-in-Progress")).otherwise(F.lit("")))
    folder = F.concat(folder, F.when(known(status), sub).otherwise(F.lit("")))
    return F.struct(F.concat_ws("_", *parts).alias("formatted_name"), folder.alias("suggested_folder"))


def a_projects(clients: Sequence[str] | str = (), col: str | Column = STEM, version_format: str = "v",
               include_status: bool = True) -> Column:
    """Client (spaces -> '-'), residual project, version, status, separator-free date, in one step."""
    from .extract import PROJECT_DATE, PROJECT_STATUS, PROJECT_VERSION, classify_keywords
    from .text import title_case
    c = col_of(col)
    if isinstance(clients, str):
        clients = [x.strip() for x in clients.split(",") if x.strip()]
    client = F.lit("unknown")
    for name in reversed(list(clients)):
        client = F.when(F.lower(c).contains(name.lower()), F.lit(name.replace(" ", "-"))).otherwise(client)
    ver = F.lit("unknown")
    for rx in reversed(PROJECT_VERSION):
        two = re.compile(rx).groups == 2
        v = F.concat(F.regexp_extract(c, rx, 1), F.lit("."), F.regexp_extract(c, rx, 2)) if two else F.regexp_extract(c, rx, 1)
        ver = F.when(c.rlike(rx), v).otherwise(ver)
    status = classify_keywords(PROJECT_STATUS, "unknown", c)
    date = F.lit("unknown")
    for rx in reversed(PROJECT_DATE):
        date = F.when(c.rlike(rx), F.regexp_replace(F.regexp_extract(c, rx, 1), "[-_]", "")).otherwise(date)
    rest = c
    for item in (client, ver, status, date):
        rest = F.when(item != "unknown", F.replace(rest, item, F.lit(""))).otherwise(rest)
    rest = F.regexp_replace(F.regexp_replace(rest, r"[_\-.]+", "_"), r"^[_\-.]+|[_\-.]+$", "")
    parts = [F.when(client != "unknown", client), F.when(rest == "", F.lit("Project")).otherwise(rest),
             F.when(ver != "unknown", F.concat(F.lit(version_format), ver))]
    if include_status:
        parts.append(F.when(status != "unknown", title_case(status)))
    parts.append(F.when(date != "unknown", date))
    return F.concat_ws("_", *parts)


# --- fixed values: hierarchical-path vocabularies ----------------------------
H_DEPT_NAMES = {"hr": "HR", "human resources": "HR", "it": "IT", "fin": "Finance", "financial": "Finance",
                "legal": "Legal", "marketing": "Marketing", "ops": "Operations", "operations": "Operations"}
H_SUFFIXES = [("CORPORATION", "CORP"), ("INCORPORATED", "INC"), ("LIMITED", "LTD"), ("COMPANY", "CO")]
H_ACRONYMS = ["API", "UI", "UX", "IT", "HR", "QA"]


def clean_component(c: Column) -> Column:
    """'_'/'-' -> spaces, split on whitespace, acronyms upper, other words capitalised, joined by '-'."""
    from .text import capitalize
    words = F.filter(F.split(F.regexp_replace(c, "[_-]", " "), r"\s+"), lambda w: w != "")
    fixed = F.transform(words, lambda w: F.when(F.upper(w).isin(*H_ACRONYMS), F.upper(w)).otherwise(capitalize(w)))
    return F.array_join(fixed, "-")


def t_hierarchical(fields: str | Column = "fields", quarter: str | Column = "quarter", ext: str | Column = "extension",
                   fallback_quarter: str = "2024-Q1") -> Column:
    """``Department/CLIENT/quarter/DocType-vNN.n-Description.ext`` from corporate fields.

    NULL fields count as absent; a missing or short quarter takes ``fallback_quarter`` (Q25).
    """
    from .convert import map_values
    from .text import title_case
    s = col_of(fields)
    dept_raw = F.coalesce(s.getField("dept"), s.getField("doc_type"), F.lit("General"))
    dept = map_values(F.trim(F.lower(dept_raw)), H_DEPT_NAMES,
                      default=F.replace(title_case(dept_raw), F.lit(" "), F.lit("-")), upper_key=False)
    client = F.replace(F.replace(F.upper(F.coalesce(s.getField("client"), F.lit("Unknown"))), F.lit("_"), F.lit("-")),
                       F.lit(" "), F.lit("-"))
    fixed = client
    for old, new in reversed(H_SUFFIXES):
        fixed = F.when(F.endswith(client, F.lit("-" + old)),
                       F.concat(F.substring(client, F.lit(1), F.char_length(client) - len(old)), F.lit(new))
                       ).otherwise(fixed)
    q = col_of(quarter)
    q = F.when(q.isNull() | (F.char_length(q) < 6), F.lit(fallback_quarter)).otherwise(q)
    doc_type = F.coalesce(s.getField("doc_type"), F.lit("Document"))
    v = s.getField("version")
    v = F.when(F.startswith(v, F.lit("v")), v).otherwise(F.concat(F.lit("v"), v))
    rx = r"^v(\d+)\.(\d+)"
    v = F.when(v.rlike(rx), F.concat(F.lit("v"), F.format_string("%02d", F.regexp_extract(v, rx, 1).cast("int")),
                                     F.lit("."), F.regexp_extract(v, rx, 2))).otherwise(v)
    status = s.getField("status")
    sv = (F.when(s.getField("version").isNotNull() & (s.getField("version") != ""), v)
          .when(status.isNotNull() & (status != ""), clean_component(status)))
    desc = s.getField("description")
    use_desc = desc.isNotNull() & (desc != "") & ~F.lower(doc_type).contains(F.lower(desc))
    name = F.concat(F.concat_ws("-", clean_component(doc_type), F.when(sv != "", sv),
                                F.when(use_desc, clean_component(desc))), col_of(ext))
    return F.concat_ws("/", dept, fixed, q, name)
