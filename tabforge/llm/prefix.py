"""Running sums over a whole table in a given order, without one task that sees all rows.

Rows are range-partitioned and sorted by the order, each partition sums its own rows while it is written, and the
partitions' totals - one row for each partition and group in it - give what stands before each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stage import Stage


def _running(value: str, group: str | None, out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, rows = None, 0, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            v = b.column(b.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.zeros(n, dtype=bool)
            if group:
                g = b.column(b.schema.get_field_index(group))
                codes = g.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                first[1:] = codes[1:] != codes[:-1]
                first[0] = g[0].as_py() != last
                last = g[n - 1].as_py()
            before = np.cumsum(v) - v
            start = np.where(first, np.arange(n), -1)
            start = np.maximum.accumulate(start)
            own = start >= 0
            at = np.maximum(start, 0)
            run_sum = np.where(own, before - before[at], before + total)
            run_row = np.where(own, np.arange(n) - at, np.arange(n) + rows)
            total, rows = int(run_sum[-1] + v[-1]), int(run_row[-1] + 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(run_sum), pa.array(run_row)], names=out)
    return run


def running_sums(stage: Stage, df: DataFrame, order: list[str], value: str, group: str | None = None,
                 name: str = "running", parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, totals). rows: ``df`` with ``before`` (sum of ``value`` over earlier rows of the group, long) and ``row``
    (their number, long); totals: one row for each group with ``sum`` and ``rows``.

    ``value`` is a long without nulls; ``group`` a string column or none for the whole table. Rows that tie in
    ``order`` are spread by their place in ``df``'s partitions, so a value that many rows hold is no hot task.
    ``df`` should be a written table: it is read twice, once to find the ranges.
    """
    spark = stage.spark
    keys = ([group] if group else []) + order
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.withColumn("_tie", F.monotonically_increasing_id())
    cut = cut.repartitionByRange(parts, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    cut = cut.withColumn("_part", F.spark_partition_id())
    names = cut.columns + ["_sum", "_row"]
    ddl = T.StructType([*cut.schema.fields, T.StructField("_sum", T.LongType()), T.StructField("_row", T.LongType())])
    rows = stage.put(name, cut.mapInArrow(_running(value, group, names), ddl))
    by = ["_part"] + ([group] if group else [])
    totals = stage.put(f"{name}-totals", rows.groupBy(*by).agg(F.sum(value).alias("sum"), F.count(F.lit(1)).alias("rows")))
    over = Window.partitionBy(*([group] if group else [])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(*by, F.coalesce(F.sum("sum").over(over), F.lit(0)).alias("_s"),
                          F.coalesce(F.sum("rows").over(over), F.lit(0)).alias("_r"))
    if group:
        match = (rows["_part"] == ahead["_part"]) & rows[group].eqNullSafe(ahead[group])
    else:
        match = rows["_part"] == ahead["_part"]
        ahead = F.broadcast(ahead)  # one row for each of `parts` partitions, whatever the size of the table
    out = rows.join(ahead, match).select(*[rows[c] for c in df.columns], (rows["_sum"] + F.col("_s")).alias("before"),
                                         (rows["_row"] + F.col("_r")).alias("row"))
    sums = totals.groupBy(*([group] if group else [])).agg(F.sum("sum").alias("sum"), F.sum("rows").alias("rows"))
    return out, sums
