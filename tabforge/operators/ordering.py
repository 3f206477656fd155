"""Positions in a total order without one task that sees all rows.

Rows are range-partitioned by the order and sorted; the position of a row in its partition is written with it. What
stands before a partition follows from the partitions' counts, a table of one row for each partition (and group in it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staging_path

PART, POS = "__part", "__pos"
PARTITION_BYTES = 128 << 20


def _bytes_of(df: DataFrame) -> int:
    """Bytes that ``df`` holds at most as far as known: the optimizer's size, or that of the tables it reads where this is
    less. The optimizer takes a join for the product of both sides, which grows with the square of the input."""
    plan = df._jdf.queryExecution().optimizedPlan()
    tables = plan.collectLeaves()
    read = sum(int(str(tables.apply(i).stats().sizeInBytes())) for i in range(tables.size()))
    return min(int(str(plan.stats().sizeInBytes())), read)


def partitions_for(df: DataFrame) -> int:
    """The session's shuffle partitions, or more where the size of ``df`` asks for more."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = _bytes_of(df)
    return least if size >= 1 << 60 else max(least, -(-size // PARTITION_BYTES))  # the optimizer's "unknown" is huge


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared folder and read it back."""
    path = staging_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(df: DataFrame, order: Sequence[Column], parts: int | None = None, name: str = "placed") -> DataFrame:
    """``df``, written, with ``__part`` (range partition, ascending) and ``__pos`` (row in it). NULLs come first; rows
    that tie are spread by their place in ``df``, so one value that many rows hold fills many partitions."""
    keys = [c.alias(f"__o{i}") for i, c in enumerate(order)]
    names = [f"__o{i}" for i in range(len(keys))]
    cut = df.select("*", *keys, F.monotonically_increasing_id().alias("__tie"))
    cut = cut.repartitionByRange(parts or partitions_for(df), *names, "__tie").sortWithinPartitions(*names, "__tie")
    at = F.monotonically_increasing_id()  # partition in the high 31 bits, row in the low 33
    cut = cut.drop(*names, "__tie").select("*", F.shiftright(at, 33).alias(PART), at.bitwiseAND(F.lit((1 << 33) - 1)).alias(POS))
    return write_and_read(cut, name)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the keys come once."""
    right = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}") if c in keys else F.col(f"`{c}`") for c in right.columns])
    on = None
    for k in keys:
        one = F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`"))
        on = one if on is None else on & one
    return left.join(right, on, how).drop(*[f"__r_{k}" for k in keys])


def number(df: DataFrame, order: Sequence[Column], by: str | None = None, out: str = "__n", parts: int | None = None) -> DataFrame:
    """``df`` with ``out``, the 0-based position in ``order``; within each value of column ``by`` if given (``order``
    must then begin with it)."""
    rows = placed(df, order, parts)
    keys = [PART] + ([by] if by else [])
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"), F.min(POS).alias("__p0"))
    over = Window.partitionBy(*([by] if by else [])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*keys, "__p0", F.coalesce(F.sum("__c").over(over), F.lit(0)).alias("__before"))
    out_col = (F.col("__before") + F.col(POS) - F.col("__p0")).cast("bigint").alias(out)
    return join_on(rows, groups, keys).select(*[F.col(f"`{c}`") for c in df.columns], out_col)


def running_total(df: DataFrame, order: Sequence[Column], value: str, out: str = "__before") -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` over all earlier rows."""
    rows = placed(df, order)
    inside = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = rows.groupBy(PART).agg(F.sum(value).alias("__t"))
    ahead = totals.select(PART, F.coalesce(F.sum("__t").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__s"))
    return rows.join(ahead, PART).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__in") + F.col("__s")).cast("bigint").alias(out))
