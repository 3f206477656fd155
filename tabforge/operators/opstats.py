"""L1, L2: operation pairing and processing statistics over an operation log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_operations(log: DataFrame, op_id: str, ts: str, memory: str | None = None,
                    order: Sequence[str] | None = None, phase: str | None = None) -> DataFrame:
    """L1: start and end of each operation -> duration (s) and memory delta; one partial aggregate per operation id.

    With ``phase`` (a column with 'start' and 'end', others are notes) an operation runs from its first start to its
    last end: one without a start is left out, one whose end is missing or before its start has ``status`` 'open' and
    no duration, others are 'completed'. Without ``phase`` the first and last records are start and end.
    """
    o = F.struct(*[F.col(c) for c in (order or [ts])])
    begins, ends = (F.col(phase) == "start", F.col(phase) == "end") if phase else (F.lit(True), F.lit(True))
    aggs = [F.min(F.when(begins, F.col(ts))).alias("start_time"), F.max(F.when(ends, F.col(ts))).alias("end_time"),
            F.count(F.lit(1)).cast("bigint").alias("records")]
    if memory:
        aggs += [F.min_by(memory, F.when(begins, o)).alias("start_memory"), F.max_by(memory, F.when(ends, o)).alias("end_memory")]
    out = log.groupBy(op_id).agg(*aggs).where(F.col("start_time").isNotNull())
    done = F.coalesce(F.col("end_time") >= F.col("start_time"), F.lit(False))
    out = out.withColumn("duration", F.when(done, F.unix_micros(F.col("end_time").cast("timestamp")) / 1e6
                                            - F.unix_micros(F.col("start_time").cast("timestamp")) / 1e6))
    if memory:
        out = out.withColumn("memory_delta_mb", F.when(done, F.col("end_memory") - F.col("start_memory")))
    if phase:
        out = out.withColumn("status", F.when(done, F.lit("completed")).otherwise(F.lit("open")))
    return out


def operation_stats(log: DataFrame, by: Sequence[str], files: str | None = None, rows: str | None = None,
                    duration: str = "duration", errors: str | None = None) -> DataFrame:
    """L2: files/s and success rate per group, zero-guarded.

    ``files``: column counted as processed files (default: one per record);
    ``errors``: boolean or count column of failures.
    """
    files_c = F.sum(files) if files else F.count(F.lit(1))
    err_c = F.sum(F.col(errors).cast("bigint")) if errors else F.lit(0)
    out = log.groupBy(*by).agg(
        files_c.cast("bigint").alias("files_processed"),
        (F.sum(rows) if rows else F.lit(0)).cast("bigint").alias("rows_processed"),
        F.sum(duration).alias("duration"),
        err_c.cast("bigint").alias("errors"),
    )
    return out.withColumns({
        "files_per_second": F.when(F.col("duration") > 0, F.col("files_processed") / F.col("duration")).otherwise(F.lit(0.0)),
        "success_rate": F.when(F.col("files_processed") > 0,
                               (F.col("files_processed") - F.col("errors")) / F.col("files_processed") * 100)
                         .otherwise(F.lit(0.0)),
    })
