"""Time-series operators over (key, order, value) tables.

Bounded look-back windows (the 60-point baseline, the 3-vs-3 trend, the
previous-point delta) are evaluated on *chunks* of each series, not on the
whole series: rows are numbered per key with the range-partitioned numbering,
cut into chunks of ``chunk_rows`` and every chunk receives the ``lookback``
rows before it as a halo. A key holding a third of all rows is
therefore spread over many tasks, and results are exact.

Whole-series statistics (min/max for bars and sparklines, report figures) are
partial aggregates per key joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .indexing import with_index
from .ordering import join_on, write_and_read

CHUNK_ROWS = 1_000_000
LOOKBACK = 59


def chunked(df: DataFrame, key: str, order: Sequence[str], lookback: int = LOOKBACK,
            chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``__pos`` (0-based position in the key's series), ``__chunk`` and ``__halo``.

    Evaluate windows with :func:`chunk_window`, then drop halo rows with
    ``filter(~__halo)``.
    """
    if lookback >= chunk_rows:
        raise ValueError("chunk_rows must exceed the look-back")
    pos = with_index(df, "local", file_col=key, order_by=list(order), index_col="__pos")
    chunk = F.floor(F.col("__pos") / chunk_rows).cast("bigint")
    own = F.struct(chunk.alias("__chunk"), F.lit(False).alias("__halo"))
    next_ = F.struct((chunk + 1).alias("__chunk"), F.lit(True).alias("__halo"))
    near_end = F.col("__pos") % chunk_rows >= chunk_rows - lookback
    return (pos.withColumn("__c", F.explode(F.when(near_end, F.array(own, next_)).otherwise(F.array(own))))
            .select(*[F.col(f"`{c}`") for c in pos.columns], "__c.__chunk", "__c.__halo"))


def chunk_window(key: str, start: int, end: int = 0):
    return Window.partitionBy(key, "__chunk").orderBy("__pos").rowsBetween(start, end)


def rolling_bands(df: DataFrame, key: str, order: Sequence[str], value: str, n: int = 60,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """L8 (+L9, L10, L14 columns): baseline and yellow/red thresholds over the last ``n`` points.

    <5 points: none; 5-19: mean, max(1.25 mean, mean+10), max(1.5 mean, mean+25);
    >=20: mean, mean+sd, mean+2 sd (sample sd).
    """
    c = chunked(df, key, order, n - 1, chunk_rows)
    w = chunk_window(key, -(n - 1), 0)
    cnt = F.least(F.col("__pos") + 1, F.lit(n))
    mean = F.avg(value).over(w)
    sd = F.stddev_samp(value).over(w)
    out = c.withColumns({
        "__n": cnt,
        "__m": mean,
        "__sd": sd,
    })
    few = F.col("__n") < 5
    mid = F.col("__n") < 20
    m, s = F.col("__m"), F.col("__sd")
    out = out.withColumns({
        "baseline": F.when(~few, m),
        "yellow": F.when(few, F.lit(None)).when(mid, F.greatest(m * 1.25, m + 10)).otherwise(m + s),
        "red": F.when(few, F.lit(None)).when(mid, F.greatest(m * 1.5, m + 25)).otherwise(m + 2 * s),
    })
    return out.filter(~F.col("__halo")).drop("__n", "__m", "__sd", "__chunk", "__halo")


def classify_band(value: Column | str, yellow: Column | str, red: Column | str) -> Column:
    """Red / yellow / normal; a threshold counts only when > 0."""
    v = F.col(value) if isinstance(value, str) else value
    y = F.col(yellow) if isinstance(yellow, str) else yellow
    r = F.col(red) if isinstance(red, str) else red
    return (F.when((v > r) & (r > 0), F.lit("red"))
            .when((v > y) & (y > 0), F.lit("yellow")).otherwise(F.lit("normal")))


def trend(df: DataFrame, key: str, order: Sequence[str], value: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean of the last 3 points vs the 3 before: up (>+10 %), down (<-10 %), flat; <6 points -> flat."""
    c = chunked(df, key, order, 5, chunk_rows)
    recent = F.avg(value).over(chunk_window(key, -2, 0))
    older = F.avg(value).over(chunk_window(key, -5, -3))
    lbl = (F.when(F.col("__pos") < 5, F.lit("flat"))
           .when(recent > older * 1.1, F.lit("up"))
           .when(recent < older * 0.9, F.lit("down")).otherwise(F.lit("flat")))
    return c.withColumn("trend", lbl).filter(~F.col("__halo")).drop("__chunk", "__halo")


def delta(df: DataFrame, key: str, order: Sequence[str], value: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Change vs the previous point; ``stable`` under 0.1, else signed ``x.xMB`` (first point: 0)."""
    c = chunked(df, key, order, 1, chunk_rows)
    prev = F.lag(value, 1).over(Window.partitionBy(key, "__chunk").orderBy("__pos"))
    d = F.col(value) - F.coalesce(prev, F.col(value))
    txt = F.when(F.abs(d) < 0.1, F.lit("stable")).otherwise(
        F.concat(F.when(d > 0, F.lit("+")).otherwise(F.lit("")), F.format_string("%.1f", d), F.lit("MB")))
    return c.withColumn("delta", d).withColumn("delta_text", txt).filter(~F.col("__halo")).drop("__chunk", "__halo")


def band(value: Column | str, thresholds: Sequence[tuple[float, str]], default: str = "green") -> Column:
    """First threshold (checked in order) the value exceeds gives the label."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.lit(default)
    for t, label in reversed(list(thresholds)):
        out = F.when(v > t, F.lit(label)).otherwise(out)
    return out


def _with_key_stats(df: DataFrame, key: str, value: str, stats: dict[str, Column]) -> DataFrame:
    # a written table: the join then has a plain exchange on both sides, and adaptive execution can split a hot key
    agg = write_and_read(df.groupBy(key).agg(*[c.alias(n) for n, c in stats.items()]), "key-stats")
    return join_on(df, agg, [key], "left")


def text_bar(df: DataFrame, key: str, value: str, width: int = 40) -> DataFrame:
    """Bar of ``width`` cells scaled by the series maximum."""
    out = _with_key_stats(df, key, value, {"__max": F.max(value)})
    filled = F.when(F.col("__max") > 0, F.floor(F.col(value) / F.col("__max") * width).cast("int")).otherwise(F.lit(0))
    filled = F.greatest(F.least(filled, F.lit(width)), F.lit(0))
    return out.withColumn("bar", F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled))) \
        .drop("__max")


# --- fixed values: sparkline levels (low to high) ---------------------------
SPARK_LEVELS = ["▁", "▂", "▃", "▄", "▅", "▆", "▇", "█"]


def spark_char(value: Column, lo: Column, hi: Column) -> Column:
    """L13 for one point: 8 levels by min-max scaling; flat series -> '▄'."""
    norm = (value - lo) / (hi - lo)
    out = F.lit(SPARK_LEVELS[0])
    for i in range(1, 8):
        out = F.when(norm >= i / 8, F.lit(SPARK_LEVELS[i])).otherwise(out)
    return F.when(hi == lo, F.lit("▄")).otherwise(out)


def sparkline(df: DataFrame, key: str, order: Sequence[str], value: str, n: int = 60,
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per point, its level char (whole-series min/max) and the sparkline of the last ``n`` points.

    The string is bounded by ``n`` characters (the widget's 60-point history);
    it is built from an ordered window, never from a whole-series collect.
    """
    out = _with_key_stats(df, key, value, {"__lo": F.min(value), "__hi": F.max(value)})
    out = out.withColumn("spark", spark_char(F.col(value), F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
    c = chunked(out, key, order, n - 1, chunk_rows)
    hist = F.collect_list("spark").over(chunk_window(key, -(n - 1), 0))
    return c.withColumn("sparkline", F.array_join(hist, "")).filter(~F.col("__halo")).drop("__chunk", "__halo")


def sparkline_full(df: DataFrame, key: str, order: Sequence[str], value: str, part_rows: int = 100_000) -> DataFrame:
    """L13 over whole series: one row for each key and part of ``part_rows`` points, (key, part, sparkline).

    Levels are scaled by the whole series; a series' text is its parts in order. A part bounds what one row holds.
    """
    out = _with_key_stats(df, key, value, {"__lo": F.min(value), "__hi": F.max(value)})
    out = out.select(key, *order, spark_char(F.col(value), F.col("__lo"), F.col("__hi")).alias("__s"))
    pos = with_index(out, "local", file_col=key, order_by=list(order), index_col="__pos")
    part = F.floor(F.col("__pos") / part_rows).cast("bigint").alias("part")
    points = F.sort_array(F.collect_list(F.struct("__pos", "__s")))
    return (pos.groupBy(key, part).agg(points.alias("__p"))
            .select(key, "part", F.array_join(F.transform("__p", lambda p: p["__s"]), "").alias("sparkline")))


def percent_of(value: Column | str, cap: float = 512.0) -> Column:
    """``x.x%`` of a capacity (half-up on decimal digits)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.concat(F.format_string("%.1f", F.round(v / cap * 100, 1)), F.lit("%"))


def resource_report(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Per key start/peak/end/average, peak per point, grade A-D, trend label, needs_optimisation.

    One partial aggregate per key (start/end via ``min_by``/``max_by`` on the order).
    """
    o = F.struct(*[F.col(c) for c in order])
    r = df.groupBy(key).agg(
        F.min_by(value, o).alias("start_value"),
        F.max(value).alias("peak_value"),
        F.max_by(value, o).alias("end_value"),
        F.avg(value).alias("average_value"),
        F.count(F.lit(1)).cast("bigint").alias("points"),
    )
    eff = F.col("peak_value") / F.col("points")
    grade = (F.when(eff < 0.5, F.lit("A")).when(eff < 1.0, F.lit("B")).when(eff < 2.0, F.lit("C")).otherwise(F.lit("D")))
    tr = (F.when(F.col("end_value") > F.col("start_value") * 1.5, F.lit("memory leak detected"))
          .when(F.col("end_value") < F.col("start_value") * 0.8, F.lit("efficient cleanup"))
          .otherwise(F.lit("normal behavior")))
    return r.withColumns({"efficiency": eff, "grade": grade, "trend": tr}) \
        .withColumn("needs_optimization", F.col("grade").isin("C", "D"))
