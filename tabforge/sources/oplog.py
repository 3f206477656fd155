"""Structured operation logs (one JSON object per line).

Core fields get a declared schema; every other top-level key (the logger's
``extra`` fields) is kept in a ``MAP<STRING, STRING>``; the exception block
is a struct with its traceback lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the JSON log record layout --------------------------------
CORE_FIELDS = ["timestamp", "level", "logger", "message", "module", "function", "line", "exception"]
EXCEPTION = "type STRING, message STRING, traceback ARRAY<STRING>"


def parse_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Parse a column of JSON log lines into typed columns plus ``extra``: one parse of a line, and one of its
    exception block where there is one."""
    rows = lines.select(F.from_json(F.col(col), "MAP<STRING, STRING>").alias("m"))
    core = lambda k: F.col("m").getItem(k)
    names = F.array(*[F.lit(k) for k in CORE_FIELDS])
    return rows.select(
        F.to_timestamp(core("timestamp")).alias("timestamp"), *[core(k).alias(k) for k in CORE_FIELDS[1:6]],
        core("line").try_cast("int").alias("line"),
        F.when(core("exception").isNotNull(), F.from_json(core("exception"), EXCEPTION)).alias("exception"),
        F.map_filter("m", lambda k, v: ~F.array_contains(names, k)).alias("extra"))


def read_operation_log(spark: SparkSession, path: str) -> DataFrame:
    """Read JSON-lines log files (a file, folder or glob) as a typed table."""
    return parse_log_lines(spark.read.text(path))
