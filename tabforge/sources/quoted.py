"""CSV records whose quoted fields hold line breaks (S3), cut in parallel.

A line is a function of one bit: whether it begins inside a quoted field tells whether it ends inside one. Such functions
are constant, the identity or the exchange of both states, and compose; so the state at any line follows from the last
constant line before it and the number of exchanges since. The composition is taken inside each split of a file, then
over the table of splits, then handed back to the lines - no file is read by one task. A record goes from a line that
begins outside quotes up to the line that ends outside; only lines of records of several lines are grouped.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import write_and_read


def line_ends(line: Column, opts: Mapping[str, str]) -> tuple[Column, Column]:
    """(ends inside quotes if it begins outside, ... if it begins inside) of a line, by separator, quote and escape."""
    quote, sep, escape = opts.get("quote") or "", opts["sep"], opts.get("escape") or ""
    if not quote:
        return F.lit(False), F.lit(False)
    q, s = re.escape(quote), re.escape(sep)
    esc = re.escape(escape) if escape and escape != quote else ""
    plain = f"[^{q}{esc}]*+"
    body = f"{plain}(?:(?:{q}{q}{f'|{esc}.' if esc else ''}){plain})*+"
    rest = f"(?:(?!{s}).)*+"
    field = f"(?:{q}{body}{q}{rest}|(?!{q}){rest})"
    tail = f"{esc}?+$" if esc else "$"
    opened = f"(?:{field}{s})*+ *{q}{body}{tail}"
    return F.contains(line, F.lit(quote)) & line.rlike(f"^{opened}"), line.rlike(f"^{body}{tail}") | line.rlike(f"^{body}{q}{rest}{s}{opened}")


def composed(df: DataFrame, keys: list[str], order: str, e0: str, e1: str) -> DataFrame:
    """Adds ``p0`` and ``p1``: the state before each row if its group begins in state 0 or 1; ``e0`` and ``e1`` are ints."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col(e0) > F.col(e1)).cast("int")
    df = df.withColumn("_s", F.coalesce(F.sum(swap).over(w), F.lit(0)))
    df = df.withColumn("_k", F.max(F.when(F.col(e0) == F.col(e1), F.struct(F.col(order), ((F.col(e0) + F.col("_s")) % 2).alias("v")))).over(w))
    state = lambda a: ((F.coalesce(F.col("_k.v"), F.lit(a)) + F.col("_s")) % 2).cast("int")
    return df.withColumns({"p0": state(0), "p1": state(1)}).drop("_s", "_k")


def whole_records(lines: DataFrame, opts: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(records, broken). ``lines``: source_file, blk, mid, line, skip - all lines of files; ``skip`` marks those that are no
    record unless they stand inside a field. records: source_file, blk, mid, line, the place being that of the first line,
    without gaps inside a split; lines of a record are joined by a line feed. broken: files whose last field never ends.
    """
    out, inside = line_ends(F.col("line"), opts)
    rows = lines.withColumns({"e0": (out & ~F.col("skip")).cast("int"), "e1": inside.cast("int")})
    rows = write_and_read(composed(rows, ["source_file", "blk"], "mid", "e0", "e1"), "quoted-lines")
    after = lambda p: F.when(F.col(p) == 0, F.col("e0")).otherwise(F.col("e1"))
    splits = rows.groupBy("source_file", "blk").agg(F.max_by(after("p0"), "mid").alias("e0"), F.max_by(after("p1"), "mid").alias("e1"))
    splits = composed(splits, ["source_file"], "blk", "e0", "e1")
    splits = write_and_read(splits.select("source_file", "blk", F.col("p0").alias("begins"), after("p0").alias("ends")), "quoted-splits")
    broken = splits.groupBy("source_file").agg(F.max_by("ends", "blk").alias("open")).where("open = 1").select("source_file")

    rows = rows.join(splits.drop("ends"), ["source_file", "blk"]).withColumn("st", F.when(F.col("begins") == 0, F.col("p0")).otherwise(F.col("p1")))
    rows = rows.withColumn("en", after("st")).join(broken, "source_file", "left_anti").where("st = 1 OR NOT skip")
    one = rows.where("st = 0 AND en = 0").select("source_file", "blk", "mid", "line")
    many = write_and_read(rows.where("st = 1 OR en = 1").select("source_file", "blk", "mid", "line", "st"), "quoted-parts")
    w = Window.partitionBy("source_file", "blk").orderBy("mid")
    many = many.withColumn("head", F.max(F.when(F.col("st") == 0, F.col("mid"))).over(w))
    last = many.groupBy("source_file", "blk").agg(F.max("head").alias("mid"))
    w = Window.partitionBy("source_file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select("source_file", "blk", F.max(F.when(F.col("mid").isNotNull(), F.struct("blk", "mid"))).over(w).alias("before"))
    many = many.join(before, ["source_file", "blk"]).withColumn("at", F.when(F.col("head").isNotNull(), F.struct("blk", F.col("head").alias("mid"))).otherwise(F.col("before")))
    joined = (many.groupBy("source_file", "at").agg(F.sort_array(F.collect_list(F.struct("blk", "mid", "line"))).alias("parts"))
              .select("source_file", "at.blk", "at.mid", F.array_join(F.transform("parts", lambda x: x["line"]), "\n").alias("line")))
    w = Window.partitionBy("source_file", "blk").orderBy("mid")
    return one.unionByName(joined).withColumn("mid", F.row_number().over(w).cast("long")), broken
