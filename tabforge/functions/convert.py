"""Field conversion on a fields STRUCT and scalar string/date helpers.

Struct converters replace one field with ``withField``; a NULL struct (no
fields) passes through unchanged; an empty value is left as is; a field that
is not in the struct is a build-time error (C4).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import capitalize, col_of, strptime_to_spark, title_case


def _check_field(fields_type: T.DataType | None, field: str):
    if fields_type is not None and isinstance(fields_type, T.StructType) and field not in fields_type.fieldNames():
        raise ValueError(f"no field {field!r} to convert; the fields are {fields_type.fieldNames()}")


def _convert(fields: str | Column, field: str, fn, fields_type: T.DataType | None = None) -> Column:
    _check_field(fields_type, field)
    s = col_of(fields)
    v = s.getField(field)
    new = F.when(v.isNull() | (v == ""), v).otherwise(fn(v))
    return s.withField(field, new)


def pad_digits(v: Column, width: int) -> Column:
    """C1 on a string: all digits, zero-padded to ``width``, replace their first occurrence."""
    digits = F.regexp_replace(v, r"[^0-9]", "")
    padded = F.when(F.char_length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    at = F.position(digits, v)
    return (F.when(digits == "", v)
            .when(at > 0, F.overlay(v, padded, at, F.char_length(digits)))
            .otherwise(v))


def c_pad_numbers(fields: str | Column, field: str, width: int = 3, fields_type=None) -> Column:
    """Pad the digits of a field (non-contiguous digits -> unchanged)."""
    return _convert(fields, field, lambda v: pad_digits(v, int(width)), fields_type)


def reformat_date(v: Column, in_fmt: str = "%Y%m%d", out_fmt: str = "%Y-%m-%d") -> Column:
    """C2 on a string: parse with one strptime format, print with another; unparsable -> unchanged."""
    parsed = F.try_to_timestamp(v, F.lit(strptime_to_spark(in_fmt)))
    return F.coalesce(F.date_format(parsed, strptime_to_spark(out_fmt)), v)


def c_date_format(fields: str | Column, field: str, in_fmt: str = "%Y%m%d", out_fmt: str = "%Y-%m-%d",
                  fields_type=None) -> Column:
    """Date re-format of one field."""
    return _convert(fields, field, lambda v: reformat_date(v, in_fmt, out_fmt), fields_type)


CASES = ("upper", "lower", "title", "capitalize")


def change_case(v: Column, kind: str) -> Column:
    if kind == "upper":
        return F.upper(v)
    if kind == "lower":
        return F.lower(v)
    if kind == "title":
        return title_case(v)
    if kind == "capitalize":
        return capitalize(v)
    raise ValueError(f"unknown case {kind!r}; one of {', '.join(CASES)}")


def c_case(fields: str | Column, field: str, kind: str = "lower", fields_type=None) -> Column:
    """Upper / lower / title / capitalize one field."""
    change_case(F.lit(""), kind)  # validate at build time
    return _convert(fields, field, lambda v: change_case(v, kind), fields_type)


def map_values(c: str | Column, mapping: Mapping[str, str], default: Column | None = None, upper_key: bool = True) -> Column:
    """Dictionary lookup (keys upper-cased), default = title case of the input."""
    c = col_of(c)
    key = F.upper(c) if upper_key else c
    lut = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k.upper() if upper_key else k), F.lit(v))])
    return F.coalesce(F.element_at(lut, key), default if default is not None else title_case(c))


def parse_date_any(c: str | Column) -> Column:
    """8 chars -> yyyyMMdd, contains '-' -> yyyy-MM-dd; returns a TIMESTAMP or NULL."""
    c = col_of(c)
    return (F.when(F.char_length(c) == 8, F.try_to_timestamp(c, F.lit("yyyyMMdd")))
            .when(c.contains("-"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))))


# --- fixed values: department and document-type standardisation --------------
DEPT_NAMES = {
    "HR": "Human-Resources", "IT": "Information-Technology", "FIN": "Finance", "FINANCE": "Finance",
    "LEGAL": "Legal", "OPS": "Operations", "OPERATIONS": "Operations", "SALES": "Sales",
    "MARKETING": "Marketing", "MKT": "Marketing",
}
TYPE_NAMES = {
    "POLICY": "Policy", "PROCEDURE": "Procedure", "REPORT": "Report", "MEETING": "Meeting-Notes",
    "CONTRACT": "Contract", "INVOICE": "Invoice", "PROPOSAL": "Proposal", "PRESENTATION": "Presentation",
}


def c_business(fields: str | Column, stem: str | Column = "base_name") -> Column:
    """dept_full, dept_code, type_formatted, date_iso/compact, year, month, formatted_name."""
    s = col_of(fields)
    dept, typ, date = s.getField("dept"), s.getField("type"), s.getField("date")
    has_dept = dept.isNotNull() & (dept != "")
    has_type = typ.isNotNull() & (typ != "")
    dept_full = F.when(has_dept, map_values(dept, DEPT_NAMES))
    type_fmt = F.when(has_type, map_values(typ, TYPE_NAMES))
    usable = date.isNotNull() & (date != "") & (date != "unknown")
    parsed = parse_date_any(date)
    tried = usable & ((F.char_length(date) == 8) | date.contains("-"))
    iso = F.when(tried, F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit("unknown")))
    compact = F.when(tried, F.coalesce(F.date_format(parsed, "yyyyMMdd"), F.lit("unknown")))
    name = (F.when(dept_full.isNotNull() & type_fmt.isNotNull() & iso.isNotNull(),
                   F.concat_ws("_", dept_full, type_fmt, iso))
            .when(dept_full.isNotNull() & type_fmt.isNotNull(), F.concat_ws("_", dept_full, type_fmt))
            .otherwise(col_of(stem)))
    return (s.withField("dept_full", dept_full).withField("dept_code", F.when(has_dept, F.upper(dept)))
             .withField("type_formatted", type_fmt).withField("date_iso", iso).withField("date_compact", compact)
             .withField("year", F.date_format(parsed, "yyyy")).withField("month", F.date_format(parsed, "MM"))
             .withField("formatted_name", name))


LEGAL_SUFFIX = r"(?i)\b(inc|ltd|llc|corp|co)\b"


def clean_company(c: str | Column) -> Column:
    """Drop legal-suffix words, special characters, spaces -> '-', title case."""
    c = col_of(c)
    x = F.regexp_replace(c, LEGAL_SUFFIX, "")
    x = F.regexp_replace(x, r"(?U)[^\w\s-]", "")
    x = F.regexp_replace(F.trim(x), r"\s+", "-")
    return title_case(x)


def c_invoice(fields: str | Column, company_prefix: bool = True, stem: str | Column = "base_name") -> Column:
    """company_clean, 6-digit number_padded, date_formatted, formatted_name (prefix switch).

    No extracted fields -> only ``formatted_name`` = stem (other fields NULL).
    """
    s = col_of(fields)
    company, number, date = s.getField("company"), s.getField("number"), s.getField("date")
    known = lambda v: v.isNotNull() & (v != "") & (v != "unknown")
    clean = F.when(known(company), clean_company(company)).otherwise(F.lit("Unknown-Company"))
    as_int = F.trim(number).try_cast("bigint")
    num = (F.when(known(number) & as_int.isNotNull(), F.format_string("%06d", as_int))
           .when(known(number), number).otherwise(F.lit("000000")))
    iso = F.try_to_timestamp(date, F.lit("yyyy-MM-dd"))
    dfmt = (F.when(known(date) & date.contains("-"), F.coalesce(F.date_format(iso, "yyyy-MM-dd"), F.lit("unknown")))
            .when(known(date), date).otherwise(F.lit("unknown")))
    with_date = dfmt != "unknown"
    if company_prefix:
        name = F.when(with_date, F.concat_ws("_", clean, F.lit("Invoice"), num, dfmt)) \
            .otherwise(F.concat_ws("_", clean, F.lit("Invoice"), num))
    else:
        name = F.when(with_date, F.concat_ws("_", F.lit("Invoice"), num, clean, dfmt)) \
            .otherwise(F.concat_ws("_", F.lit("Invoice"), num, clean))
    full = (s.withField("company_clean", clean).withField("number_padded", num)
             .withField("date_formatted", dfmt).withField("formatted_name", name))
    return full


# --- fixed values: client tiers (checked in order) ---------------------------
CLIENT_TIERS = {"enterprise": ["corp", "global", "mega", "enterprise"], "startup": ["startup", "tech", "labs"]}


def client_tier(c: str | Column) -> Column:
    """Enterprise / startup / standard by substrings of the lower-cased client."""
    low = F.lower(F.coalesce(col_of(c), F.lit("")))
    out = F.lit("standard")
    for tier, words in reversed(list(CLIENT_TIERS.items())):
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        out = F.when(hit, F.lit(tier)).otherwise(out)
    return out


def quarter_of(c: str | Column, fallback: str | Column) -> Column:
    """C14: 8 chars = yyyymmdd, 6 chars = mmddyy -> 'yyyy-Qn'; otherwise ``fallback`` (Q25)."""
    c = col_of(c)
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    n = F.char_length(c)
    y8, m8 = F.substring(c, 1, 4).try_cast("int"), F.substring(c, 5, 2).try_cast("int")
    m6, y6 = F.substring(c, 1, 2).try_cast("int"), F.substring(c, 5, 2).try_cast("int")
    year = F.when(n == 8, y8).when(n == 6, F.lit(2000) + y6)
    month = F.when(n == 8, m8).when(n == 6, m6)
    q = F.floor((month - 1) / 3).cast("int") + 1
    return F.when(year.isNotNull() & month.isNotNull(), F.format_string("%d-Q%d", year, q)).otherwise(fb)


# --- fixed values: retention years by classification (default 3) ------------
RETENTION_YEARS = {
    "Legal-Contract": 7, "Legal-Agreement": 7, "Legal-Compliance": 10, "Finance-Audit": 7, "Finance-Budget": 5,
    "Finance-Statement": 7, "HR-Policy": 5, "HR-Handbook": 5, "HR-Training": 3, "General-Document": 3,
}


def retention_years(classification: str | Column) -> Column:
    """Retention lookup, default 3 (a missing class counts as General-Document)."""
    c = F.coalesce(col_of(classification), F.lit("General-Document"))
    lut = F.create_map(*[x for k, v in RETENTION_YEARS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(lut, c), F.lit(3)).cast("bigint")


def confidentiality(classification: str | Column, name: str | Column) -> Column:
    """C17: explicit markers in the lower-cased name, else by classification prefix."""
    low = F.lower(col_of(name))
    cls = F.coalesce(col_of(classification), F.lit(""))
    return (F.when(low.contains("confidential"), F.lit("CONFIDENTIAL"))
            .when(low.contains("internal"), F.lit("INTERNAL"))
            .when(low.contains("public"), F.lit("PUBLIC"))
            .when(F.startswith(cls, F.lit("Legal-")), F.lit("CONFIDENTIAL"))
            .when(F.startswith(cls, F.lit("Finance-")), F.lit("RESTRICTED"))
            .otherwise(F.lit("INTERNAL")))


def check_fields(before: T.StructType, after: T.StructType) -> dict[str, list[str]]:
    """C18 at build time: names a conversion removes or adds."""
    b, a = before.fieldNames(), after.fieldNames()
    return {"removed": [f for f in b if f not in a], "added": [f for f in a if f not in b]}


def emptied_fields(before: str | Column, after: str | Column, before_type: T.StructType, after_type: T.StructType) -> Column:
    """C18 for each row: names of the fields that had text before a conversion and have none after it."""
    b, a = col_of(before), col_of(after)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    kept = [f for f in before_type.fieldNames() if f in after_type.fieldNames()]
    return F.array_compact(F.array(*[F.when((text(b.getField(f)) != "") & (text(a.getField(f)) == ""), F.lit(f)) for f in kept]))


# --- fixed values: document classes by department (checked in this order) ---
DOC_CLASSES = {
    ("legal", "law"): [("contract", "Legal-Contract"), ("agreement", "Legal-Agreement"), ("compliance", "Legal-Compliance")],
    ("finance", "fin"): [("audit", "Finance-Audit"), ("budget", "Finance-Budget"), ("financial", "Finance-Statement")],
    ("hr", "human resources"): [("policy", "HR-Policy"), ("handbook", "HR-Handbook"), ("training", "HR-Training")],
}


def classify_document(dept: str | Column, doc_type: str | Column, name: str | Column) -> Column:
    """Department-specific keyword classes in doc type or lower-cased name; default General-Document."""
    d = F.lower(F.coalesce(col_of(dept), F.lit("")))
    t = F.lower(F.coalesce(col_of(doc_type), F.lit("")))
    low = F.lower(col_of(name))
    out = F.lit("General-Document")
    for depts, rules in reversed(list(DOC_CLASSES.items())):
        inner = F.lit("General-Document")
        for key, label in reversed(rules):
            inner = F.when(t.contains(key) | low.contains(key), F.lit(label)).otherwise(inner)
        out = F.when(d.isin(*depts), inner).otherwise(out)
    return out


def c_photo(fields: str | Column, stem: str | Column = "base_name", include_device: bool = False,
            group_by_month: bool = True) -> Column:
    """C10 over X8 fields: formatted_name (date, time, [device], non-default type) and suggested_folder."""
    s = col_of(fields)
    date, time, device, kind, year = (s.getField(n) for n in ("date", "time", "device", "type", "year"))
    known = lambda v: v.isNotNull() & (v != "") & (v != "unknown")
    dashed = F.split(date, "-", -1)
    ym = F.when(date.contains("-"), F.array_join(F.slice(dashed, 1, 2), "-")) \
        .otherwise(F.concat(F.substring(date, 1, 4), F.lit("-"), F.substring(date, 5, 2)))
    parts = [F.when(known(date), F.replace(date, F.lit("-"), F.lit(""))),
             F.when(known(time), F.replace(time, F.lit("-"), F.lit("")))]
    if include_device:
        parts.append(F.when(known(device), device))
    parts.append(F.when(kind.isNotNull() & (kind != "") & (kind != "Photo"), kind))
    name = F.concat_ws("_", *parts)
    name = F.when(name == "", col_of(stem)).otherwise(name)
    if group_by_month:
        folder = F.when(known(date), F.concat(F.lit("Photos/"), ym))
    else:
        folder = F.lit(None).cast("string")
    folder = F.coalesce(folder, F.when(year.isNotNull() & (year != ""), F.concat(F.lit("Photos/"), year)),
                        F.lit("Photos/Unsorted"))
    return F.struct(name.alias("formatted_name"), folder.alias("suggested_folder"))
