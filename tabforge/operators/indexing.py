"""Row numbering (I1-I4) without a global single-partition sort.

* File order (default): readers in ``tabforge.sources`` attach ``__file``/``__blk``/``__mid`` at the scan, before any
  filter, so ``__mid - min(__mid)`` is a row's position in its split. Each split's offset is a running total over the
  table of splits, itself taken by ranges.
* Key order (``order_by`` given): :mod:`tabforge.operators.ordering` writes range partitions and adds what stands
  before each. A hot file or key, NULL included, spreads over many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import join_on, number, running_total

POS_COLS = ("__file", "__blk", "__mid")


def scan_positions(df: DataFrame) -> DataFrame:
    """Attach split-position columns; call directly on a file scan, before filters."""
    return df.withColumns({
        "__file": F.col("_metadata.file_path"),
        "__blk": F.col("_metadata.file_block_start"),
        "__mid": F.monotonically_increasing_id(),
    })


def with_index(df: DataFrame, mode: str | None = "sequential", start: int = 0, file_col: str = "source_file",
               order_by: Sequence[str | Column] | None = None, index_col: str = "row_index",
               num_partitions: int | None = None) -> DataFrame:
    """``none`` (identity), ``local`` (restart per file), ``sequential`` (one numbering).

    Files are taken in ``file_col`` order; rows inside a file in file order, or
    by ``order_by`` when given. ``None`` means ``none`` (Q8).
    """
    mode = (mode or "none").lower()
    if mode == "none":
        return df.drop(*[c for c in POS_COLS if c in df.columns])
    if mode not in ("local", "sequential"):
        raise ValueError(f"unknown index mode {mode!r}")
    if order_by is None:
        missing = [c for c in POS_COLS if c not in df.columns]
        if missing:
            raise ValueError("file-order numbering needs scan positions (use tabforge.sources readers) or order_by=")
        return _index_by_position(df, mode, start, file_col, index_col)
    return _index_by_key(df, mode, start, file_col, list(order_by), index_col, num_partitions)


def _index_by_position(df, mode, start, file_col, index_col):
    splits = (df.groupBy(file_col, "__blk")
              .agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__mid0")))
    if mode == "local":
        before = Window.partitionBy(file_col).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
        splits = splits.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    else:
        splits = running_total(splits, [F.col(file_col), F.col("__blk")], "__n", out="__off")
    out = join_on(df, splits.drop("__n"), [file_col, "__blk"], "left")
    idx = (F.lit(start) + F.col("__off") + (F.col("__mid") - F.col("__mid0"))).cast("bigint")
    return out.withColumn(index_col, idx).drop("__off", "__mid0", *POS_COLS)


def _index_by_key(df, mode, start, file_col, order_by, index_col, num_partitions):
    order = [F.col(file_col)] + [F.col(c) if isinstance(c, str) else c for c in order_by]
    rows = df.drop(*[c for c in POS_COLS if c in df.columns])
    out = number(rows, order, by=file_col if mode == "local" else None, out=index_col, parts=num_partitions)
    return out.withColumn(index_col, (F.col(index_col) + start).cast("bigint"))
