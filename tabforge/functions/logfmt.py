"""Log field formatting and flags as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# --- fixed values: byte multipliers of the size parser ----------------------
SIZE_SUFFIX = {"KB": 1024, "MB": 1024 * 1024, "GB": 1024 * 1024 * 1024}


def format_duration(c: str | Column) -> Column:
    """L3: <1 ms -> 'NNNμs', <1 s -> 'N.Nms', <60 s -> 'N.NNs', else 'NmN.Ns'.

    Decimal digits round half-up (Spark ``format_string`` on a rounded value).
    """
    d = col_of(c).cast("double")
    mins = F.floor(d / 60).cast("bigint")
    secs = d - mins * 60
    return (F.when(d.isNull(), F.lit(None))
            .when(d < 0.001, F.concat(F.format_string("%.0f", F.round(d * 1e6, 0)), F.lit("μs")))
            .when(d < 1, F.concat(F.format_string("%.1f", F.round(d * 1000, 1)), F.lit("ms")))
            .when(d < 60, F.concat(F.format_string("%.2f", F.round(d, 2)), F.lit("s")))
            .otherwise(F.concat(mins.cast("string"), F.lit("m"), F.format_string("%.1f", F.round(secs, 1)), F.lit("s"))))


def format_errors(c: str | Column) -> Column:
    """L4: '1 error' / 'n errors'."""
    n = col_of(c).cast("bigint")
    return F.when(n == 1, F.lit("1 error")).otherwise(F.concat(n.cast("string"), F.lit(" errors")))


def _present(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def log_flags(user_id="user_id", request_id=None, file_name=None, file_count=None, error_count=None,
              duration="duration") -> dict[str, Column]:
    """Presence and slow-operation flags (slow = duration > 5 s)."""
    out = {}
    if user_id is not None:
        out["has_user"] = _present(col_of(user_id))
    if request_id is not None:
        out["has_request_id"] = _present(col_of(request_id))
    if file_name is not None:
        out["has_file_name"] = _present(col_of(file_name))
    if file_count is not None:
        out["has_file_count"] = F.coalesce(col_of(file_count) > 0, F.lit(False))
    if error_count is not None:
        out["has_error_count"] = F.coalesce(col_of(error_count) > 0, F.lit(False))
    if duration is not None:
        out["has_duration"] = col_of(duration).isNotNull()
        out["is_slow"] = F.coalesce(col_of(duration).cast("double") > 5.0, F.lit(False))
    return out


def parse_size(c: str | Column) -> Column:
    """L7: '10KB' / '5MB' / '2GB' / '123' -> bytes (upper-cased; bad text -> NULL)."""
    s = F.upper(F.trim(col_of(c)))
    num = F.regexp_extract(s, r"^([0-9]+)(KB|MB|GB)?$", 1).try_cast("bigint")
    unit = F.regexp_extract(s, r"^([0-9]+)(KB|MB|GB)?$", 2)
    mult = F.when(unit == "KB", F.lit(SIZE_SUFFIX["KB"])).when(unit == "MB", F.lit(SIZE_SUFFIX["MB"])) \
        .when(unit == "GB", F.lit(SIZE_SUFFIX["GB"])).otherwise(F.lit(1))
    return (num * mult).cast("bigint")


# --- fixed values: sections of the default text-log line, in order ----------
LOG_LINE = ("{{[;level;]}} {{time}} {{name}} {{?user;(User: ;user_id;) }}{{?request;[Req: ;request_id;] }}{{message}}"
            "{{?timed; in ;{$duration_text}duration}}{{?files; ;file_count; files)}}{{?errors; - ;{$error_text}error_count}}"
            "{{?memory;;memory_mb;MB]}}{{?slow; ⚠️ SLOW ;duration;}}")


def log_line(level="level", time="time", name="name", message="message", user_id=None, request_id=None, duration=None,
             file_count=None, error_count=None, memory_mb=None, time_format: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """The default line of a text log from the named columns (or Columns); absent ones leave their section out."""
    from .template import compile_template
    given = {"level": level, "time": F.date_format(col_of(time), time_format), "name": name, "message": message, "user_id": user_id,
             "request_id": request_id, "duration": duration, "file_count": file_count, "error_count": error_count, "memory_mb": memory_mb}
    cols = {k: col_of(v) for k, v in given.items() if v is not None}
    flags = log_flags(user_id=cols.get("user_id"), request_id=cols.get("request_id"), file_count=cols.get("file_count"),
                      error_count=cols.get("error_count"), duration=cols.get("duration"))
    no = F.lit(False)
    functions = {
        "user": lambda: flags.get("has_user", no), "request": lambda: flags.get("has_request_id", no),
        "timed": lambda: flags.get("has_duration", no), "files": lambda: flags.get("has_file_count", no),
        "errors": lambda: flags.get("has_error_count", no), "slow": lambda: flags.get("is_slow", no),
        "memory": lambda: F.coalesce(cols["memory_mb"] > 0, no) if "memory_mb" in cols else no,
        "duration_text": lambda: format_duration(cols["duration"]) if "duration" in cols else F.lit(""),
        "error_text": lambda: format_errors(cols["error_count"]) if "error_count" in cols else F.lit(""),
    }
    return compile_template(LOG_LINE, functions=functions, resolver=cols)
