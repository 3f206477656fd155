"""K1-K4: table sinks and plan sink.

``write_table`` writes a directory of part files (one per task), so writes
scale with the cluster; CSV carries its header in every part file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folder import JSON_WRITE_ALIASES, WRITE_OPTION_ALIASES, filter_options

FORMATS = ("csv", "json", "parquet")


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite",
                index_col: str | None = None, keep_index: bool = True, options: Mapping | None = None) -> str:
    """K1/K2 (+I4): write ``df``; format from ``fmt`` or the path's extension (K4).

    ``keep_index=False`` drops ``index_col`` (the index mode decides, never a
    low-level write option).
    """
    fmt = (fmt or path.rsplit(".", 1)[-1]).lower()
    if fmt not in FORMATS:
        raise ValueError(f"unsupported output format {fmt!r}; use one of {', '.join(FORMATS)}")
    if index_col and not keep_index and index_col in df.columns:
        df = df.drop(index_col)
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", "true").options(**filter_options(options, WRITE_OPTION_ALIASES))
        w.csv(path)
    elif fmt == "json":
        w.options(**filter_options(options, JSON_WRITE_ALIASES)).json(path)
    else:
        w.parquet(path)
    return path


def write_plan(plan: DataFrame, path: str, action_col: str = "action") -> str:
    """K3: persist a rename plan as Parquet partitioned by action."""
    if action_col not in plan.columns:
        plan = plan.withColumn(action_col, F.when(F.col("old_name") == F.col("new_name"), F.lit("keep"))
                               .otherwise(F.lit("rename")))
    plan.write.mode("overwrite").partitionBy(action_col).parquet(path)
    return path
