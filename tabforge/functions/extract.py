"""Field extraction, string -> STRUCT of named string fields.

A NULL struct means "no fields extracted" (regex no-match); later steps pass
it through and templates fall back to the stem.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, java_quote, title_case

STEM = "base_name"


def x_split(delim: str, *names: str, col: str | Column = STEM) -> Column:
    """Split on a literal delimiter; missing part -> ''; extra parts ignored."""
    if not names:
        raise ValueError("split needs at least one field name")
    parts = F.split(col_of(col), java_quote(delim), -1)
    return F.struct(*[F.coalesce(F.get(parts, i), F.lit("")).alias(n) for i, n in enumerate(names)])


def _java_regex(pattern: str) -> tuple[str, dict[str, int], int]:
    """Python regex -> Java regex with named groups turned into numbered ones."""
    rx = re.compile(pattern)
    java = re.sub(r"\(\?P<[A-Za-z_][A-Za-z0-9_]*>", "(", pattern)
    java = re.sub(r"\(\?P=([A-Za-z_][A-Za-z0-9_]*)\)", lambda m: "\\" + str(rx.groupindex[m.group(1)]), java)
    return java, dict(rx.groupindex), rx.groups


def _optional_groups(pattern: str) -> set[int]:
    """Numbers of the groups that a match can leave out: those below an alternation or a repetition from zero."""
    found: set[int] = set()

    def walk(items, loose: bool):
        for op, arg in items:
            name = str(op)
            if name == "SUBPATTERN":
                if loose and arg[0]:
                    found.add(arg[0])
                walk(arg[3], loose)
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                walk(arg[2], loose or arg[0] == 0)
            elif name == "BRANCH":
                for option in arg[1]:
                    walk(option, True)
            elif name in ("ASSERT", "ASSERT_NOT"):
                walk(arg[1], loose or name == "ASSERT_NOT")
            elif name == "ATOMIC_GROUP":
                walk(arg, loose)
            elif name == "GROUPREF_EXISTS":
                for option in arg[1:]:
                    walk(option or (), True)

    walk(re._parser.parse(pattern), False)
    return found


def _took_part(java: str, group: int) -> str:
    """A regex that matches where the first match of ``java`` sets ``group``.

    An empty marker group at the group's end can only be referred back to if the group took part; the search for the
    first match is atomic, so that no other match is tried.
    """
    opened, stack, i, in_class, before = 0, [], 0, False, 0
    while i < len(java):
        ch = java[i]
        if ch == "\\":
            i += 1
        elif in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch == "(":
            captures = java[i + 1:i + 2] != "?"
            opened += captures
            stack.append(opened if captures else 0)
        elif ch == ")" and stack.pop() == group:
            before = opened
            break
        i += 1
    marker = before + 1
    marked = re.sub(r"\\([1-9])", lambda m: f"\\{int(m[1]) + (int(m[1]) >= marker)}", java[:i] + "()" + java[i:])
    return rf"^(?>(?s:.*?)(?:{marked}))\{marker}"


def x_regex(pattern: str, col: str | Column = STEM, **fields: str) -> Column:
    """First match anywhere; named groups, or ``fieldN=name`` for numbered ones.

    No match -> NULL struct; a group that takes no part in the match -> NULL.
    """
    java, named, n_groups = _java_regex(pattern)
    c = col_of(col)
    if named:
        items = sorted(named.items(), key=lambda kv: kv[1])
    else:
        items = []
        for k, name in fields.items():
            m = re.fullmatch(r"field(\d+)", k)
            if not m:
                raise ValueError(f"unexpected argument {k!r}")
            idx = int(m.group(1))
            if idx <= n_groups:
                items.append((name, idx))
        items.sort(key=lambda kv: kv[1])
    if not items:  # a match without mapped groups extracts nothing either
        return F.lit(None).cast("struct<matched:string>")
    loose = _optional_groups(pattern)

    def value(i: int) -> Column:
        v = F.regexp_extract(c, java, i)
        return F.when((v != "") | c.rlike(_took_part(java, i)), v) if i in loose else v

    return F.when(c.rlike(java), F.struct(*[value(i).alias(n) for n, i in items]))


def parse_position_specs(*specs: str) -> list[tuple[int, int | None, str]]:
    if len(specs) == 1 and "," in specs[0]:
        specs = tuple(s.strip() for s in specs[0].split(","))
    out = []
    for spec in specs:
        if ":" not in spec:
            raise ValueError(f"invalid position spec {spec!r}: use 'start-end:name' or 'start:name'")
        pos, name = spec.split(":", 1)
        if "-" in pos:
            a, b = pos.split("-", 1)
            out.append((int(a), int(b), name))
        else:
            out.append((int(pos), None, name))
    return out


def x_position(*specs: str, col: str | Column = STEM) -> Column:
    """``start-end:name`` (end inclusive) or ``start:name``; out of range -> ''."""
    c = col_of(col)
    fields = []
    for start, end, name in parse_position_specs(*specs):
        length = 1 if end is None else max(end - start + 1, 0)
        fields.append(F.when(F.char_length(c) > start, F.substring(c, start + 1, length)).otherwise(F.lit("")).alias(name))
    return F.struct(*fields)


def x_metadata(*names: str, created: str = "created", modified: str = "modified", size: str = "size") -> Column:
    """created/modified as yyyy-MM-dd, size in whole KB ('0' under 1 KB); NULL -> ''."""
    names = names or ("created", "modified", "size")
    out = []
    for n in names:
        if n in ("created", "modified"):
            src = F.col(created if n == "created" else modified)
            out.append(F.coalesce(F.date_format(src, "yyyy-MM-dd"), F.lit("")).alias(n))
        elif n == "size":
            s = F.col(size)
            out.append(F.coalesce(F.floor(s / 1024).cast("bigint").cast("string"), F.lit("")).alias(n))
        else:
            raise ValueError(f"unknown metadata field {n!r}; available: created, modified, size")
    return F.struct(*out)


def x_business_doc(col: str | Column = STEM) -> Column:
    """Parts by '_': >=3 -> dept,type,date; 2 -> date 'unknown'; else dept 'misc', type = stem."""
    c = col_of(col)
    parts = F.split(c, "_", -1)
    n = F.size(parts)
    return F.struct(
        F.when(n >= 2, F.get(parts, 0)).otherwise(F.lit("misc")).alias("dept"),
        F.when(n >= 2, F.get(parts, 1)).otherwise(c).alias("type"),
        F.when(n >= 3, F.get(parts, 2)).otherwise(F.lit("unknown")).alias("date"),
    )


def x_regex_cascade(rules: Sequence[tuple[str, Mapping[str, object]]], default: Mapping[str, str],
                    col: str | Column = STEM) -> Column:
    """General first-matching-pattern extractor (X7, X11 use it).

    ``rules``: ``[(java_regex, {field: group index | literal str | (index, fallback)})]``;
    the first matching rule fills the fields; otherwise ``default``.
    """
    c = col_of(col)
    names = list(default.keys())

    def value(spec, rx):
        if isinstance(spec, int):
            return F.regexp_extract(c, rx, spec)
        if isinstance(spec, tuple):
            idx, fb = spec
            return F.coalesce(F.nullif(F.regexp_extract(c, rx, idx), F.lit("")), F.lit(fb))
        return F.lit(spec)

    out = {n: F.lit(default[n]) for n in names}
    for rx, spec in reversed(list(rules)):
        hit = c.rlike(rx)
        for n in names:
            out[n] = F.when(hit, value(spec.get(n, default[n]), rx)).otherwise(out[n])
    return F.struct(*[out[n].alias(n) for n in names])


# --- fixed values: invoice patterns (first match wins, case-insensitive) -----
INVOICE_PATTERNS = [
    r"(?i)Invoice[_-](\d+)[_-]([^_-]+)(?:[_-](\d{4}-\d{2}-\d{2}))?",
    r"(?i)INV[_-](\d+)[_-]([^_-]+)",
    r"(?i)(\d+)[_-]Invoice[_-]([^_-]+)",
]


def x_invoice(col: str | Column = STEM) -> Column:
    """Invoice name cascade -> type, number, company, date."""
    rules = [
        (INVOICE_PATTERNS[0], {"type": "Invoice", "number": 1, "company": 2, "date": (3, "unknown")}),
        (INVOICE_PATTERNS[1], {"type": "Invoice", "number": 1, "company": 2, "date": "unknown"}),
        (INVOICE_PATTERNS[2], {"type": "Invoice", "number": 1, "company": 2, "date": "unknown"}),
    ]
    default = {"type": "Document", "number": "unknown", "company": "unknown", "date": "unknown"}
    return x_regex_cascade(rules, default, col)


# --- fixed values: camera prefixes and device names --------------------------
DEVICE_PREFIX = r"(?i)^(IMG|DSC|DCIM|P\d+)_"
DEVICE_NAMES = r"(?i)(iPhone|Samsung|Pixel|Canon|Nikon|Sony)"


def x_photo(col: str | Column = STEM, modified: str | Column = "modified", device: bool = True) -> Column:
    """Date (first 8-digit run, else modification time), time (first 6-digit run), device, type.

    As in the reference the time is read from the *first* six digits of the
    name, which for ``IMG_yyyymmdd_hhmmss`` are the date's first six digits.
    An 8-digit run that is not a valid date gives ``date='unknown'`` and no
    year/month/day.
    """
    c = col_of(col)
    d8 = F.regexp_extract(c, r"(\d{8})", 1)
    parsed = F.try_to_timestamp(d8, F.lit("yyyyMMdd"))
    mod = col_of(modified)
    day = F.when(d8 != "", parsed).otherwise(mod)
    date = F.when((d8 != "") & parsed.isNull(), F.lit("unknown")).otherwise(
        F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("unknown")))
    t6 = F.regexp_extract(c, r"(\d{6})", 1)
    tparsed = F.try_to_timestamp(F.concat(F.lit("19700101"), t6), F.lit("yyyyMMddHHmmss"))
    time = F.when(t6 == "", F.lit("unknown")).when(tparsed.isNull(), F.lit("unknown")).otherwise(
        F.date_format(tparsed, "HH-mm-ss"))
    hour = F.when((t6 != "") & tparsed.isNotNull(), F.date_format(tparsed, "HH"))
    up = F.upper(c)
    kind = (F.when(up.contains("IMG"), F.lit("Photo")).when(up.contains("VID"), F.lit("Video"))
            .when(up.contains("SCR") | c.contains("Screenshot"), F.lit("Screenshot")).otherwise(F.lit("Media")))
    fields = [
        date.alias("date"),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
        time.alias("time"),
        hour.alias("hour"),
    ]
    if device:
        dev = (F.when(c.rlike(DEVICE_PREFIX), F.regexp_extract(c, DEVICE_PREFIX, 1))
               .when(c.rlike(DEVICE_NAMES), F.regexp_extract(c, DEVICE_NAMES, 1)).otherwise(F.lit("unknown")))
        fields.append(dev.alias("device"))
    fields.append(kind.alias("type"))
    return F.struct(*fields)


def classify_keywords(rules: Mapping[str, Sequence[str]], default: str = "unknown", col: str | Column = STEM,
                      lower: bool = True) -> Column:
    """First label (in order) with any keyword contained in the text."""
    c = F.lower(col_of(col)) if lower else col_of(col)
    out = F.lit(default)
    for label, kws in reversed(list(rules.items())):
        hit = F.lit(False)
        for k in kws:
            hit = hit | c.contains(k.lower() if lower else k)
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


# --- fixed values: project status keywords (checked in this order) ----------
PROJECT_STATUS = {
    "draft": ["draft", "wip", "work"],
    "review": ["review", "rev", "check"],
    "final": ["final", "approved", "delivery"],
    "archive": ["old", "archive", "backup"],
}
# version patterns, first match wins; two groups -> "a.b"
PROJECT_VERSION = [r"[vV](\d+)\.(\d+)", r"[vV](\d+)", r"_(\d+)\.(\d+)_", r"_(\d+)_", r"rev(\d+)", r"r(\d+)"]
PROJECT_DATE = [r"(\d{4}[-_]\d{2}[-_]\d{2})", r"(\d{8})", r"(\d{2}[-_]\d{2}[-_]\d{4})"]


def x_project(clients: Sequence[str] | str = (), col: str | Column = STEM, version: bool = True) -> Column:
    """Client (first known name contained, case-insensitive), version, status, date, residual project."""
    c = col_of(col)
    if isinstance(clients, str):
        clients = [x.strip() for x in clients.split(",") if x.strip()]
    client = F.lit("unknown")
    for name in reversed(list(clients)):
        client = F.when(F.lower(c).contains(name.lower()), F.lit(name)).otherwise(client)
    ver = F.lit("unknown")
    for rx in reversed(PROJECT_VERSION):
        two = re.compile(rx).groups == 2
        v = F.concat(F.regexp_extract(c, rx, 1), F.lit("."), F.regexp_extract(c, rx, 2)) if two else F.regexp_extract(c, rx, 1)
        ver = F.when(c.rlike(rx), v).otherwise(ver)
    status = classify_keywords(PROJECT_STATUS, "unknown", c)
    date = F.lit("unknown")
    for rx in reversed(PROJECT_DATE):
        date = F.when(c.rlike(rx), F.regexp_extract(c, rx, 1)).otherwise(date)
    rest = c
    for item in ([client] + ([ver] if version else []) + [status, date]):
        rest = F.when((item != "unknown") & (item != ""), F.replace(rest, item, F.lit(""))).otherwise(rest)
    rest = F.regexp_replace(F.regexp_replace(rest, r"[_\-.]+", "_"), r"^[_\-.]+|[_\-.]+$", "")
    fields = [client.alias("client")]
    if version:
        fields.append(ver.alias("version"))
    fields += [status.alias("status"), date.alias("date"),
               F.when(rest == "", F.lit("unknown")).otherwise(rest).alias("project")]
    return F.struct(*fields)


# --- fixed values: corporate name patterns (first match wins, on the lower-cased stem) ---
CORPORATE_PATTERNS = [
    (r"([^_]+)_([^_]+)_([^_]+)_([^_]+)_(\d{8})", ["client", "dept", "doc_type", "status", "date"]),
    (r"([^_]+)_([^_]+)_([^_]+)_v([\d.]+)_([^_]+)", ["client", "dept", "doc_type", "version", "status"]),
    (r"([^_]+)_([^_]+)_([^_]+)_(\d{6,8})", ["client", "doc_type", "description", "date"]),
]
CORPORATE_FIELDS = ["client", "dept", "doc_type", "status", "date", "version", "description"]


CORPORATE_TITLED = ["client", "dept", "doc_type", "status", "description"]


def x_corporate(col: str | Column = STEM, standardise: bool = True) -> Column:
    """X11: three patterns on the lower-cased stem, else split on ``[_-]``.

    Fields a pattern does not name are NULL; the fallback fills client,
    doc_type ('document') and description (rest joined by '_', or 'general').
    ``standardise`` writes the text fields with blanks for '_' and in title case.
    """
    c = F.lower(col_of(col))
    parts = F.split(c, "[_-]", -1)
    n = F.size(parts)
    fallback = {
        "client": F.coalesce(F.get(parts, 0), F.lit("unknown")),
        "doc_type": F.when(n > 1, F.get(parts, 1)).otherwise(F.lit("document")),
        "description": F.when(n > 2, F.array_join(F.slice(parts, 3, 1 << 30), "_")).otherwise(F.lit("general")),
    }
    out = {f: fallback.get(f, F.lit(None).cast("string")) for f in CORPORATE_FIELDS}
    for rx, names in reversed(CORPORATE_PATTERNS):
        hit = c.rlike(rx)
        for f in CORPORATE_FIELDS:
            val = F.regexp_extract(c, rx, names.index(f) + 1) if f in names else F.lit(None).cast("string")
            out[f] = F.when(hit, val).otherwise(out[f])
    if standardise:
        for f in CORPORATE_TITLED:
            out[f] = title_case(F.replace(out[f], F.lit("_"), F.lit(" ")))
    return F.struct(*[out[f].alias(f) for f in CORPORATE_FIELDS])
