"""Steps of a rename plan by name: call strings, the registry of built-in steps, and checks of custom ones.

A step is a Column builder. What its kind is given and must give back:

========== ====================== =======================
kind       called with            gives
========== ====================== =======================
filter     nothing                boolean
extractor  the catalog            struct, or map of strings
converter  fields, fields' type   struct
template   fields, fields' type   string
all_in_one the catalog            string
========== ====================== =======================

Arguments of the spec follow these. A step is analysed against an empty frame, so a wrong type is an error before any
row is read.
"""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable, Mapping, Sequence
from string import Formatter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import convert as C
from ..functions import extract as X
from ..functions import filters as FL
from ..functions import naming as N
from ..functions.template import section_template

KINDS = ("filter", "extractor", "converter", "template", "all_in_one")
GIVEN = {"filter": (), "extractor": ("catalog",), "converter": ("fields", "fields_type"), "template": ("fields", "fields_type"),
         "all_in_one": ("catalog",)}
GIVES = {"filter": (T.BooleanType,), "extractor": (T.StructType, T.MapType), "converter": (T.StructType,), "template": (T.StringType,),
         "all_in_one": (T.StringType,)}
CATALOG = "path string, file_name string, base_name string, extension string, parent string, size bigint, created timestamp, modified timestamp"

# --- call strings ------------------------------------------------------------

_TOKEN = re.compile(r"""(?P<blank>[ \t]+) | (?P<comma>,) | '(?P<single>(?:[^']|'')*)' | "(?P<double>(?:[^"]|"")*)" | (?P<plain>[^,'" \t]+|['"])""", re.X)
_KEY = re.compile(r"([A-Za-z_][A-Za-z0-9_]*)=")


def _arguments(call: str) -> list[tuple[str | None, str]]:
    """(key or None, value) of each comma-separated part: blanks around a part go, quoted text stays as it is."""
    parts, pieces = [], []

    def close():
        text = "".join(t for t, _ in pieces)
        if not any(quoted for _, quoted in pieces):
            text = text.strip(" \t")
        key = _KEY.match(text) if pieces and not pieces[0][1] else None
        parts.append((key[1], text[key.end():]) if key else (None, text))
        pieces.clear()

    for m in _TOKEN.finditer(call):
        kind, text = m.lastgroup, m[m.lastgroup]
        if kind == "comma":
            while pieces and not pieces[-1][1] and not pieces[-1][0].strip(" \t"):
                pieces.pop()
            close()
        elif kind in ("single", "double"):
            mark = m[0][0]
            pieces.append((text.replace(mark * 2, mark), True))
        elif pieces or kind == "plain":  # blanks before a part are left out
            pieces.append((text, False))
    while pieces and not pieces[-1][1] and not pieces[-1][0].strip(" \t"):
        pieces.pop()
    close()
    return parts


def parse_call(call: str) -> dict:
    """``name,arg,key=value`` -> {name, args, kwargs}; a ``!`` before the name of a filter stays with the name.

    Parts end at commas. Quotes, ' or ", keep commas, blanks and ``=``; a doubled quote inside stands for one. A quote
    that never ends is a character like any other.
    """
    (key, name), *rest = _arguments(call)
    if key or not name.lstrip("!"):
        raise ValueError(f"no step name in {call!r}")
    args, kwargs = [], {}
    for key, value in rest:
        if key is None:
            args.append(value)
        elif key in kwargs:
            raise ValueError(f"{key} is given twice in {call!r}")
        else:
            kwargs[key] = value
    return {"name": name, "args": args, "kwargs": kwargs}


def as_step(step: str | Mapping) -> Mapping:
    return parse_call(step) if isinstance(step, str) else step


# --- built-in steps ------------------------------------------------------------

#: Parameters that the plan fills in, not the spec.
_PLUMBING = {"col", "stem", "fields", "fields_type", "ext", "modified", "quarter", "content_hash", "name"}


def _value(v, default):
    if isinstance(v, str) and isinstance(default, bool):
        if v.lower() not in ("true", "false"):
            raise ValueError(f"{v!r} is neither true nor false")
        return v.lower() == "true"
    if isinstance(v, str) and isinstance(default, int):
        return int(v)
    return v


def _options(fn: Callable, args: Sequence, kwargs: Mapping) -> dict:
    """Arguments of a spec as keyword arguments of ``fn``, texts turned into the type of the default."""
    known = {p.name: p.default for p in inspect.signature(fn).parameters.values() if p.name not in _PLUMBING}
    if len(args) > len(known):
        raise ValueError(f"at most {len(known)} arguments: {', '.join(known)}")
    out = dict(zip(known, args))
    for k, v in kwargs.items():
        if k not in known or k in out:
            raise ValueError(f"unexpected argument {k!r}; arguments: {', '.join(known)}")
        out[k] = v
    missing = [n for n, d in known.items() if d is inspect.Parameter.empty and n not in out]
    if missing:
        raise ValueError(f"missing argument {missing[0]!r}")
    return {k: _value(v, known[k]) for k, v in out.items()}


def _on_catalog(fn: Callable) -> Callable:
    """Extractors and one-step renamers that read catalog columns."""
    def build(a, k):
        options = _options(fn, a, k)
        return lambda df: fn(**options)
    return build


def _clients(fn: Callable) -> Callable:
    """As :func:`_on_catalog`; positional arguments are client names."""
    def build(a, k):
        k = dict(k)
        names = list(a) or k.pop("clients", ())
        options = _options(fn, [], k)
        return lambda df: fn(clients=names, **options)
    return build


def _keywords(a, k):
    """``keywords,label=a|b,...``: the first label with a keyword in the name, as field ``category``."""
    if not k:
        raise ValueError("keywords needs label=word|word arguments")
    rules = {label: words.split("|") if isinstance(words, str) else list(words) for label, words in k.items()}
    return lambda df: F.struct(X.classify_keywords(rules, *a).alias("category"))


def _needing(fn: Callable, *names: str) -> Callable:
    """``fn`` marked with the fields that a row must have (C4)."""
    fn.needs = names
    return fn


def _one_field(fn: Callable, options: Mapping[str, object]) -> Callable:
    """Converters of one field: the field, then ``options`` (spec name -> default)."""
    def build(a, k):
        known = {"field": None, **options}
        given = dict(zip(known, a)) | {n: k[n] for n in known if n in k}
        unknown = [n for n in k if n not in known]
        if unknown or len(a) > len(known):
            raise ValueError(f"unexpected argument {(unknown or a)[-1]!r}; arguments: {', '.join(known)}")
        if not given.get("field"):
            raise ValueError("a field name is needed")
        values = [_value(given.get(n, d), d) for n, d in options.items()]
        return _needing(lambda f, t: fn(f, given["field"], *values, t), given["field"])
    return build


def _record(fn: Callable, *reads: str) -> Callable:
    """Converters that derive fields from several: the new ones are added to the old. A field that isn't there is NULL."""
    def build(a, k):
        options = _options(fn, a, k)

        def convert(f, t):
            have = t.fieldNames()
            whole = f
            for n in reads:
                if n not in have:
                    whole = whole.withField(n, F.lit(None).cast("string"))
            new = fn(whole, **options)
            names = type_of(new, empty_catalog(SparkSession.active(), t)).fieldNames()
            kept = [f.getField(n).alias(n) for n in have if n not in names]
            return F.struct(*kept, *[new.getField(n).alias(n) for n in names])
        return convert
    return build


def _template(a, k):
    fmt = a[0] if a else k["template"]

    def fill(f, t, present=None):
        return N.t_template(fmt, f, t, present=present)
    fill.reads = tuple(dict.fromkeys(n for _, n, _, _ in Formatter().parse(fmt) if n))
    fill.by_row = True
    return fill


def _join(a, k):
    unknown = [n for n in k if n != "separator"]
    if unknown:
        raise ValueError(f"unexpected argument {unknown[0]!r}; arguments: separator")
    fn = lambda f, t: N.t_join(*a, sep=k.get("separator", "_"), fields=f, fields_type=t)
    fn.reads = tuple(a)
    return fn


def _on_fields(fn: Callable) -> Callable:
    """Templates over fields."""
    def build(a, k):
        options = _options(fn, a, k)
        return lambda f, t: fn(fields=f, fields_type=t, **options)
    return build


def _hierarchical(a, k):
    options = _options(N.t_hierarchical, a, k)
    fallback = options.get("fallback_quarter", inspect.signature(N.t_hierarchical).parameters["fallback_quarter"].default)

    def build(f, t):
        for n in ("dept", "client", "doc_type", "version", "status", "description", "date"):
            if n not in t.fieldNames():
                f = f.withField(n, F.lit(None).cast("string"))
        return N.t_hierarchical(f, quarter=C.quarter_of(f.getField("date"), F.lit(fallback)), **options)
    return build


BUILTIN: dict[str, dict[str, Callable]] = {
    "filter": {
        "pattern": lambda a, k: FL.f_pattern(*(a or [k.get("include"), k.get("exclude")])),
        "file-type": lambda a, k: FL.f_file_type(*(a or [k.get("types", "")])),
        "file-size": lambda a, k: FL.f_file_size(*(a or [k.get("min_size"), k.get("max_size")])),
        "name-length": lambda a, k: FL.f_name_length(*(a or [k.get("min_length"), k.get("max_length")])),
        "date-modified": lambda a, k: FL.f_date_modified(*(a or [k.get("operator", ">"), k.get("date")])),
    },
    "extractor": {
        "split": lambda a, k: (lambda df: X.x_split(a[0], *a[1:])),
        "regex": lambda a, k: (lambda df: X.x_regex(a[0] if a else k["pattern"], **{n: v for n, v in k.items() if n != "pattern"})),
        "position": lambda a, k: (lambda df: X.x_position(*a)),
        "metadata": lambda a, k: (lambda df: X.x_metadata(*a)),
        "business-doc": _on_catalog(X.x_business_doc),
        "invoice": _on_catalog(X.x_invoice),
        "photo": _on_catalog(X.x_photo),
        "project": _clients(X.x_project),
        "keywords": _keywords,
        "corporate": _on_catalog(X.x_corporate),
    },
    "converter": {
        "pad_numbers": _one_field(C.c_pad_numbers, {"width": 3}),
        "date_format": _one_field(C.c_date_format, {"input_format": "%Y%m%d", "output_format": "%Y-%m-%d"}),
        "case": _one_field(C.c_case, {"case": "lower"}),
        "business": _record(C.c_business, "dept", "type", "date"),
        "invoice": _record(C.c_invoice, "type", "number", "company", "date"),
        "photo": _record(C.c_photo, "date", "time", "device", "type", "year"),
        "project": _record(N.c_project, "client", "project", "version", "status", "date"),
        "document": _record(N.c_document, "dept", "type", "date"),
    },
    "template": {
        "template": _template,
        "section": lambda a, k: (lambda f, t: section_template(a[0] if a else k.get("template", ""), "fields", t)),
        "join": _join,
        "business": _on_fields(N.t_business),
        "project": _on_fields(N.t_project),
        "creative": _on_fields(N.t_creative),
        "sequence": lambda a, k: (lambda f, t, o=_options(N.t_hash_sequence, a, k): N.t_hash_sequence("base_name", **o)),
        "hierarchical": _hierarchical,
    },
    "all_in_one": {
        "replace": lambda a, k: (lambda df: N.a_replace(*a)),
        "lowercase": lambda a, k: (lambda df: N.a_lower()),
        "uppercase": lambda a, k: (lambda df: N.a_upper()),
        "clean": _on_catalog(N.a_clean),
        "business": _on_catalog(N.a_business),
        "invoices": _on_catalog(N.a_invoices),
        "photos": _on_catalog(N.a_photos),
        "projects": _clients(N.a_projects),
        "media": _on_catalog(N.a_media),
    },
}
CUSTOM: dict[str, dict[str, Callable]] = {k: {} for k in KINDS}

# --- checks ------------------------------------------------------------


def empty_catalog(spark: SparkSession, fields: T.StructType | None = None) -> DataFrame:
    """No rows under the catalog's columns, and ``fields`` if given: to analyse steps against."""
    schema = T.StructType.fromDDL(CATALOG)
    if fields is not None:
        schema = T.StructType([*schema.fields, T.StructField("fields", fields)])
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def type_of(step: Column, df: DataFrame) -> T.DataType:
    return df.select(step).schema.fields[0].dataType


def check_type(kind: str, name: str, step, df: DataFrame) -> T.DataType:
    """The analysed type of ``step`` over ``df``, which must be one that its kind gives. An untyped NULL will do."""
    if not isinstance(step, Column):
        raise TypeError(f"{kind} step {name!r} gives {type(step).__name__}, not a Column")
    found = type_of(step, df)
    if not isinstance(found, (*GIVES[kind], T.NullType)):
        raise TypeError(f"{kind} step {name!r} gives {found.simpleString()}; it must give {' or '.join(t.typeName() for t in GIVES[kind])}")
    if isinstance(found, T.MapType) and not (isinstance(found.keyType, T.StringType) and isinstance(found.valueType, T.StringType)):
        raise TypeError(f"{kind} step {name!r} gives {found.simpleString()}; a map must be of strings to strings")
    return found


_UNKNOWN = ("UNRESOLVED_COLUMN", "FIELD_NOT_FOUND", "UNRESOLVED_FIELD")


def validate_step(kind: str, fn: Callable, name: str = "", args: Sequence = (), kwargs: Mapping | None = None,
                  fields: str | T.StructType | None = None, bound: bool = False) -> None:
    """``fn`` must be callable with what its kind is given and, over an empty frame, give a Column of the kind's type.

    ``fields`` (DDL or a struct type) are the fields to try converters and templates with. What can't be known yet is
    left to the plan: arguments that only the spec names (unless ``bound``), columns and fields that the empty frame
    lacks, and everything if there is no session.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown step kind {kind!r}; kinds: {', '.join(KINDS)}")
    if not callable(fn):
        raise TypeError("step must be callable")
    given, kwargs = GIVEN[kind], dict(kwargs or {})
    signature = inspect.signature(fn)
    try:
        signature.bind_partial(*given)
    except TypeError:
        raise ValueError(f"{kind} step {name!r} must take {len(given)} leading parameters: {', '.join(given)}") from None
    try:
        signature.bind(*given, *args, **kwargs)
    except TypeError as e:
        if bound:
            raise ValueError(f"{kind} step {name!r}: {e}") from None
        return
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    over_fields = kind in ("converter", "template")
    trial = (T.StructType.fromDDL(fields) if isinstance(fields, str) else fields) or T.StructType([T.StructField("field", T.StringType())])
    df = empty_catalog(spark, trial if over_fields else None)
    leading = {"filter": (), "extractor": (df,), "all_in_one": (df,)}.get(kind, (F.col("fields"), trial))
    try:
        step = fn(*leading, *args, **kwargs)
    except Exception:
        if over_fields and fields is None:  # it may look for fields of its own
            return
        raise
    try:
        check_type(kind, name, step, df)
    except AnalysisException as e:
        if not (e.getCondition() or "").startswith(_UNKNOWN):
            raise ValueError(f"{kind} step {name!r} can't be analysed: {e}") from None


def register_step(kind: str, name: str, fn: Callable, needs: Sequence[str] = (), fields: str | T.StructType | None = None) -> None:
    """Register a custom step, checked by :func:`validate_step`. ``needs`` names the fields without which a converter
    makes the row an error (C4); ``fields`` are those to try the step with."""
    if fields is None and needs:
        fields = T.StructType([T.StructField(n, T.StringType()) for n in needs])
    validate_step(kind, fn, name, fields=fields)
    CUSTOM[kind][name] = fn
    NEEDS[kind, name] = tuple(needs)


NEEDS: dict[tuple[str, str], tuple[str, ...]] = {}


def resolve(kind: str, name: str, args=(), kwargs=None):
    """The step of that name, built-in ones first, with its arguments: a filter's Column, or a builder of one."""
    args, kwargs = list(args or []), dict(kwargs or {})
    if name in BUILTIN[kind]:
        try:
            return BUILTIN[kind][name](args, kwargs)
        except KeyError as e:
            raise ValueError(f"{kind} step {name!r} needs the argument {e}") from None
    if name not in CUSTOM[kind]:
        raise ValueError(f"unknown {kind} step {name!r}; steps: {', '.join([*BUILTIN[kind], *CUSTOM[kind]])}")
    fn = CUSTOM[kind][name]
    validate_step(kind, fn, name, args, kwargs, bound=True)
    if kind == "filter":
        return fn(*args, **kwargs)
    return _needing(lambda *given: fn(*given, *args, **kwargs), *NEEDS[kind, name])
