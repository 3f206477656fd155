"""Row predicates over a catalog (or any string column).

Each ``f_*`` returns a boolean Column; combine with :func:`apply_filters`.
All arguments are checked when the plan is built (Q15: a bad argument is a
build error, never a silently dropped row).
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_of, glob_to_regex

# --- fixed values: byte-size units ------------------------------------------
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024 ** 2, "GB": 1024 ** 3, "TB": 1024 ** 4}


def parse_size_literal(v) -> int:
    """'10KB' / '1.5 MB' / 2048 -> bytes (driver side)."""
    if v is None or v == "":
        return None
    if isinstance(v, (int, float)):
        return int(v)
    m = re.fullmatch(r"\s*([0-9]*\.?[0-9]+)\s*([KMGT]?B)?\s*", str(v).upper())
    if not m:
        raise ValueError(f"invalid size {v!r}")
    return int(float(m.group(1)) * SIZE_UNITS[m.group(2) or "B"])


def f_pattern(include: str | None = None, exclude: str | None = None, col: str | Column = "file_name") -> Column:
    """include/exclude globs on the full name (case-sensitive, anchored)."""
    c = col_of(col)
    p = F.lit(True)
    if include:
        p = p & c.rlike(glob_to_regex(include))
    if exclude:
        p = p & ~c.rlike(glob_to_regex(exclude))
    return p


def _types(types) -> list[str]:
    if len(types) == 1 and isinstance(types[0], (list, tuple)):
        types = types[0]
    if len(types) == 1 and isinstance(types[0], str) and "," in types[0]:
        types = types[0].split(",")
    return [t.strip().lower().lstrip(".") for t in types if t and t.strip()]


def f_file_type(*types, col: str | Column = "extension") -> Column:
    """extension in a set; case-insensitive; dots optional; empty set keeps all."""
    allowed = _types(types)
    if not allowed:
        return F.lit(True)
    ext = F.regexp_replace(F.lower(col_of(col)), r"^\.", "")
    return ext.isin(*allowed)


def f_file_size(min_size=None, max_size=None, col: str | Column = "size") -> Column:
    """min <= size <= max (bytes; unit strings like '10KB' accepted)."""
    lo, hi = parse_size_literal(min_size), parse_size_literal(max_size)
    c = col_of(col)
    p = c >= F.lit(lo or 0)
    if hi is not None:
        p = p & (c <= F.lit(hi))
    return p


def f_name_length(min_length=None, max_length=None, col: str | Column = "base_name") -> Column:
    """min <= char_length(stem) <= max."""
    n = F.char_length(col_of(col))
    p = n >= F.lit(int(min_length or 0))
    if max_length not in (None, ""):
        p = p & (n <= F.lit(int(max_length)))
    return p


def f_date_modified(op: str = ">", date: str | None = None, col: str | Column = "modified") -> Column:
    """compare modification time to a day; ``==`` is same-day; no/invalid date keeps all."""
    if not date:
        return F.lit(True)
    try:
        day = _dt.datetime.strptime(date, "%Y-%m-%d")
    except ValueError:
        return F.lit(True)
    c = col_of(col)
    # local midnight of the day, without a time-zone shift (NTZ literal)
    t = F.to_timestamp_ntz(F.lit(day.strftime("%Y-%m-%d %H:%M:%S")))
    if op == ">":
        return c > t
    if op == "<":
        return c < t
    if op == ">=":
        return c >= t
    if op == "<=":
        return c <= t
    if op == "==":
        return F.to_date(c) == F.lit(day.date())
    return F.lit(True)


def invert(p: Column) -> Column:
    """``!name`` - NULL counts as false before inverting."""
    return ~F.coalesce(p, F.lit(False))


def all_of(predicates: Sequence[Column]) -> Column:
    """conjunction; a NULL predicate excludes the row."""
    out = F.lit(True)
    for p in predicates:
        out = out & F.coalesce(p, F.lit(False))
    return out


def apply_filters(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    return df.filter(all_of(predicates))
