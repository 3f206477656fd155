"""Operation-log queries over ``events``: S12, L1-L7, M1-M6 (template rendering)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import logfmt as L
from ..functions.template import render
from ..operators import opstats as O
from .registry import query

# Portable SQL (Spark and DuckDB): one log record per event; NULL user ids injected by modulus.
LOG_SELECT = """SELECT event_id, ts AS log_time,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
  'app.' || event_type AS logger, 'event ' || event_type || ' #' || CAST(event_id AS STRING) AS message,
  event_type AS module, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id,
  value / 3 AS duration, value / 10000 AS short_duration, event_id % 7 AS file_count,
  CASE WHEN event_type = 'error' THEN 1 + event_id % 3 ELSE 0 END AS error_count, value AS memory_mb, props
FROM {events}"""


def log(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(LOG_SELECT.replace("{events}", "{ev}"), ev=ev)


LOG_CTE = "log AS (" + LOG_SELECT.replace("{events}", "events") + ")"


def _dur_sql(d):
    return (f"CASE WHEN {d} IS NULL THEN NULL "
            f"WHEN {d} < 0.001 THEN CAST(CAST(round(CAST(CAST({d} * 1000000 AS VARCHAR) AS DECIMAL(38, 17)), 0) AS BIGINT) AS VARCHAR) || 'μs' "
            f"WHEN {d} < 1 THEN CAST(round(CAST(CAST({d} * 1000 AS VARCHAR) AS DECIMAL(38, 17)), 1) AS VARCHAR) || 'ms' "
            f"WHEN {d} < 60 THEN CAST(round(CAST(CAST({d} AS VARCHAR) AS DECIMAL(38, 17)), 2) AS VARCHAR) || 's' "
            f"ELSE CAST(CAST(floor({d} / 60) AS BIGINT) AS VARCHAR) || 'm' || "
            f"CAST(round(CAST(CAST({d} - floor({d} / 60) * 60 AS VARCHAR) AS DECIMAL(38, 17)), 1) AS VARCHAR) || 's' END")


@query("duration_text", f"WITH {LOG_CTE} SELECT event_id, {_dur_sql('duration')} AS duration_text, "
       f"{_dur_sql('short_duration')} AS short_text FROM log")
def duration_text(spark, sf_dir):
    return log(spark, sf_dir).select("event_id", L.format_duration("duration").alias("duration_text"),
                                     L.format_duration("short_duration").alias("short_text"))


@query("error_text", f"WITH {LOG_CTE} SELECT event_id, CASE WHEN error_count = 1 THEN '1 error' "
       "ELSE CAST(error_count AS VARCHAR) || ' errors' END AS errors FROM log")
def error_text(spark, sf_dir):
    return log(spark, sf_dir).select("event_id", L.format_errors("error_count").alias("errors"))


@query("log_flags", f"WITH {LOG_CTE} SELECT event_id, user_id IS NOT NULL AND trim(CAST(user_id AS VARCHAR)) <> '' AS has_user, "
       "coalesce(file_count > 0, false) AS has_file_count, coalesce(error_count > 0, false) AS has_error_count, "
       "duration IS NOT NULL AS has_duration, coalesce(duration > 5.0, false) AS is_slow FROM log")
def log_flags(spark, sf_dir):
    flags = L.log_flags(user_id="user_id", file_count="file_count", error_count="error_count", duration="duration")
    return log(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in flags.items()])


@query("parse_size", "SELECT event_id, CAST(floor(value) AS BIGINT) * CASE event_id % 4 WHEN 1 THEN 1024 "
       "WHEN 2 THEN 1048576 WHEN 3 THEN 1073741824 ELSE 1 END AS bytes FROM events")
def parse_size(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    unit = F.element_at(F.array(F.lit(""), F.lit("kb"), F.lit("MB"), F.lit("Gb")), (F.col("event_id") % 4 + 1).cast("int"))
    text = F.concat(F.floor("value").cast("bigint").cast("string"), unit)
    return ev.select("event_id", L.parse_size(text).alias("bytes"))


@query("pair_operations", """SELECT user_id || ':' || event_type AS op_id, count(*) AS records,
  sround(epoch(max(ts)) - epoch(min(ts)), 3) AS duration,
  sround(arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)), 4) AS memory_delta_mb
FROM events GROUP BY 1""")
def pair_operations(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "op_id", F.concat_ws(":", F.col("user_id").cast("string"), "event_type"))
    p = O.pair_operations(ev, "op_id", "ts", memory="value", order=["ts", "event_id"])
    return p.select("op_id", "records", F.round("duration", 3).alias("duration"),
                    F.round("memory_delta_mb", 4).alias("memory_delta_mb"))


@query("operation_phases", """WITH l AS (SELECT user_id % 500 AS op_id, ts, value,
  CASE event_id % 4 WHEN 0 THEN 'start' WHEN 1 THEN 'end' ELSE 'note' END AS phase FROM events
  WHERE NOT (user_id % 7 = 1 AND event_id % 4 = 0) AND NOT (user_id % 7 = 2 AND event_id % 4 = 1)),
s AS (SELECT op_id, min(ts) AS t0 FROM l WHERE phase = 'start' GROUP BY op_id),
e AS (SELECT op_id, max(ts) AS t1 FROM l WHERE phase = 'end' GROUP BY op_id)
SELECT op_id, CASE WHEN t1 >= t0 THEN sround(epoch(t1) - epoch(t0), 3) END AS duration,
  CASE WHEN t1 >= t0 THEN 'completed' ELSE 'open' END AS status FROM s LEFT JOIN e USING (op_id)""")
def operation_phases(spark, sf_dir):
    """L1 by phase: an end without a start yields nothing, a start without an end stays open."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        (F.col("user_id") % 500).alias("op_id"), "ts", "value", "event_id", "user_id",
        F.expr("CASE event_id % 4 WHEN 0 THEN 'start' WHEN 1 THEN 'end' ELSE 'note' END").alias("phase"))
    ev = ev.where("NOT (user_id % 7 = 1 AND event_id % 4 = 0) AND NOT (user_id % 7 = 2 AND event_id % 4 = 1)")
    p = O.pair_operations(ev, "op_id", "ts", phase="phase")
    return p.select("op_id", F.round("duration", 3).alias("duration"), "status")


@query("operation_stats", """SELECT user_id, count(*) AS files_processed, CAST(sum(event_id % 7) AS BIGINT) AS rows_processed,
  sround(sum(value / 3), 4) AS duration, count(*) FILTER (WHERE event_type = 'error') AS errors,
  sround(CASE WHEN sum(value / 3) > 0 THEN count(*) / sum(value / 3) ELSE 0 END, 6) AS files_per_second,
  sround((count(*) - count(*) FILTER (WHERE event_type = 'error')) * 100.0 / count(*), 6) AS success_rate
FROM events GROUP BY user_id""")
def operation_stats(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", (F.col("value") / 3).alias("duration"), (F.col("event_id") % 7).alias("file_rows"),
        (F.col("event_type") == "error").alias("failed"))
    s = O.operation_stats(ev, ["user_id"], rows="file_rows", duration="duration", errors="failed")
    return s.select("user_id", "files_processed", "rows_processed", F.round("duration", 4).alias("duration"), "errors",
                    F.round("files_per_second", 6).alias("files_per_second"), F.round("success_rate", 6).alias("success_rate"))


# ------------------------------------------------------------------ template rendering

@query("render_sections", f"WITH {LOG_CTE} SELECT event_id, "
       "CASE WHEN user_id IS NULL THEN '' ELSE 'User: ' || CAST(user_id AS VARCHAR) END || ' ' || "
       "CASE WHEN module IS NULL THEN '' ELSE '(Module ' || module || ')' END || "
       "' {{literal}} ' || CASE WHEN level IS NULL THEN '' ELSE level END AS text FROM log")
def render_sections(spark, sf_dir):
    """M1/M2: vanishing sections, literal text, styles stripped, escaped braces."""
    tpl = "{{User: ;user_id;}} {{#blue@bold;(Module ;module;)}} \\{{literal}} {{!level}}"
    return render(log(spark, sf_dir), tpl).select("event_id", "text")


def has_user(user_id):
    return user_id.isNotNull() & (F.trim(user_id.cast("string")) != "")


def is_slow(duration):
    return duration > 5.0


@query("render_conditional", f"WITH {LOG_CTE} SELECT event_id, "
       "CASE WHEN user_id IS NOT NULL AND trim(CAST(user_id AS VARCHAR)) <> '' THEN '(User: ' || CAST(user_id AS VARCHAR) || ') ' ELSE '' END "
       "|| CASE WHEN duration > 5.0 AND message IS NOT NULL THEN 'SLOW ' || message ELSE '' END AS text FROM log")
def render_conditional(spark, sf_dir):
    """M4/M6: ``?fn`` sections; ``is_slow`` takes a field by parameter name."""
    tpl = "{{?has_user;(User: ;user_id;) }}{{?is_slow;SLOW ;message;}}"
    return render(log(spark, sf_dir), tpl, functions=[has_user, is_slow]).select("event_id", "text")


def level_tag(level):
    return F.concat(F.lit("["), F.substring(level, 1, 1), F.lit("]"))


_ERRORS = "CASE WHEN error_count = 1 THEN '1 error' ELSE CAST(error_count AS VARCHAR) || ' errors' END"


@query("render_transform", f"WITH {LOG_CTE} SELECT event_id, "
       "CASE WHEN level IS NULL THEN '' ELSE '[' || substr(level, 1, 1) || ']' || level END || ' ' || "
       f"CASE WHEN error_count IS NULL THEN '' ELSE 'had ' || {_ERRORS} || ' = ' || CAST(error_count AS VARCHAR) || {_ERRORS} END AS text FROM log")
def render_transform(spark, sf_dir):
    """M5: a header ``$fn`` goes before the first part, an inline ``{$fn}`` replaces a part's text (here also a suffix)."""
    tpl = "{{$level_tag;level}} {{had ;{$format_errors}error_count;}}{{ = ;error_count;{$format_errors}}}"
    fns = {"level_tag": level_tag, "format_errors": L.format_errors}
    return render(log(spark, sf_dir), tpl, functions=fns).select("event_id", "text")


@query("render_mandatory_flag", f"WITH {LOG_CTE} SELECT event_id, "
       "CASE WHEN user_id IS NULL THEN '' ELSE CAST(user_id AS VARCHAR) END || ' did ' || module AS text, "
       "CASE WHEN user_id IS NULL THEN 'missing mandatory field user_id' END AS text_error FROM log")
def render_mandatory_flag(spark, sf_dir):
    """M3 with ``on_missing='flag'``: the row carries an error instead of failing the job."""
    return render(log(spark, sf_dir), "{{!user_id}} did {{module}}", on_missing="flag").select("event_id", "text", "text_error")


_REQ = "CASE WHEN event_id % 4 = 0 THEN 'r' || CAST(event_id AS {t}) END"


@query("render_log", f"""WITH {LOG_CTE}, l AS (SELECT *, {_REQ.format(t='VARCHAR')} AS request_id, floor(memory_mb) / 4 AS took,
  CAST(floor(memory_mb) AS BIGINT) - 50 AS mem FROM log)
SELECT event_id, '[' || level || '] ' || strftime(log_time, '%Y-%m-%d %H:%M:%S') || ' ' || logger || ' '
  || CASE WHEN user_id IS NOT NULL THEN '(User: ' || CAST(user_id AS VARCHAR) || ') ' ELSE '' END
  || CASE WHEN request_id IS NOT NULL THEN '[Req: ' || request_id || '] ' ELSE '' END || message || ' in ' || {_dur_sql('took')}
  || CASE WHEN file_count > 0 THEN ' ' || CAST(file_count AS VARCHAR) || ' files)' ELSE '' END
  || CASE WHEN error_count > 0 THEN ' - ' || {_ERRORS} ELSE '' END
  || CASE WHEN mem > 0 THEN CAST(mem AS VARCHAR) || 'MB]' ELSE '' END
  || CASE WHEN took > 5.0 THEN ' ⚠️ SLOW ' || CAST(took AS VARCHAR) ELSE '' END AS line FROM l""")
def render_log(spark, sf_dir):
    """The default text-log line with all of its sections."""
    took = F.floor("memory_mb") / 4
    line = L.log_line(time="log_time", name="logger", user_id="user_id", request_id=F.expr(_REQ.format(t="STRING")), duration=took,
                      file_count="file_count", error_count="error_count", memory_mb=F.floor("memory_mb").cast("bigint") - 50)
    return log(spark, sf_dir).select("event_id", line.alias("line"))
