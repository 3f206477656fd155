"""Time-series queries over ``events`` (key user_id, order ts/event_id, value): L8-L16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as S
from ..operators.indexing import with_index
from .registry import query

KEY, ORDER, VAL = "user_id", ["ts", "event_id"], "value"
W60 = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "value")


def money(spark, sf_dir):
    return events(spark, sf_dir).withColumn("value", F.col("value").cast("decimal(18,2)"))


# Values have two decimals: the means are taken on DECIMAL(18,2) so both engines agree exactly.
BANDS_SQL = f"""WITH w AS (SELECT user_id, event_id, value, count(*) OVER {W60} AS n,
  CAST(avg(CAST(value AS DECIMAL(18, 2))) OVER {W60} AS DECIMAL(38, 6)) AS m, stddev_samp(value) OVER {W60} AS sd FROM events),
b AS (SELECT user_id, event_id, value,
  CASE WHEN n >= 5 THEN m END AS baseline,
  CASE WHEN n < 5 THEN NULL WHEN n < 20 THEN greatest(CAST(m AS DOUBLE) * 1.25, m + 10) ELSE m + sd END AS yellow,
  CASE WHEN n < 5 THEN NULL WHEN n < 20 THEN greatest(CAST(m AS DOUBLE) * 1.5, m + 25) ELSE m + 2 * sd END AS red FROM w)"""


@query("rolling_bands", BANDS_SQL + " SELECT user_id, event_id, sround(baseline, 4) AS baseline, "
       "sround(yellow, 4) AS yellow, sround(red, 4) AS red FROM b")
def rolling_bands(spark, sf_dir):
    b = S.rolling_bands(money(spark, sf_dir), KEY, ORDER, VAL)
    return b.select(KEY, "event_id", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("baseline", "yellow", "red")])


@query("band_class", BANDS_SQL + " SELECT user_id, event_id, CASE WHEN value > red AND red > 0 THEN 'red' "
       "WHEN value > yellow AND yellow > 0 THEN 'yellow' ELSE 'normal' END AS band FROM b")
def band_class(spark, sf_dir):
    b = S.rolling_bands(money(spark, sf_dir), KEY, ORDER, VAL)
    return b.select(KEY, "event_id", S.classify_band("value", "yellow", "red").alias("band"))


@query("trend", """WITH w AS (SELECT user_id, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
  avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent,
  avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 3 PRECEDING) AS older FROM events)
SELECT user_id, event_id, CASE WHEN rn < 6 THEN 'flat' WHEN recent > older * 1.1 THEN 'up'
  WHEN recent < older * 0.9 THEN 'down' ELSE 'flat' END AS trend FROM w""")
def trend(spark, sf_dir):
    return S.trend(events(spark, sf_dir), KEY, ORDER, VAL).select(KEY, "event_id", "trend")


@query("fixed_bands", "SELECT event_id, CASE WHEN value > 100 THEN 'red' WHEN value > 75 THEN 'yellow' "
       "ELSE 'green' END AS band FROM events")
def fixed_bands(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", S.band("value", [(100, "red"), (75, "yellow")]).alias("band"))


@query("text_bar", """WITH m AS (SELECT user_id, max(value) AS mx FROM events GROUP BY user_id),
f AS (SELECT e.event_id, CASE WHEN m.mx > 0 THEN greatest(least(CAST(floor(e.value / m.mx * 40) AS INTEGER), 40), 0) ELSE 0 END AS k
  FROM events e JOIN m USING (user_id))
SELECT event_id, repeat('█', k) || repeat('░', 40 - k) AS bar FROM f""")
def text_bar(spark, sf_dir):
    return S.text_bar(events(spark, sf_dir), KEY, VAL).select("event_id", "bar")


def _spark_sql():
    lv = S.SPARK_LEVELS
    arms = " ".join(f"WHEN (value - lo) / (hi - lo) >= {i}/8 THEN '{lv[i]}'" for i in range(7, 0, -1))
    return f"CASE WHEN hi = lo THEN '▄' {arms} ELSE '{lv[0]}' END"


@query("sparkline", f"""WITH m AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM events GROUP BY user_id),
c AS (SELECT e.user_id, e.event_id, e.ts, {_spark_sql()} AS spark FROM events e JOIN m USING (user_id))
SELECT user_id, event_id, spark, array_to_string(list(spark) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), '') AS sparkline FROM c""")
def sparkline(spark, sf_dir):
    return S.sparkline(events(spark, sf_dir), KEY, ORDER, VAL).select(KEY, "event_id", "spark", "sparkline")


@query("delta_text", """WITH d AS (SELECT user_id, event_id, value - coalesce(lag(value) OVER (PARTITION BY user_id
  ORDER BY ts, event_id), value) AS delta FROM events)
SELECT user_id, event_id, sround(delta, 4) AS delta,
  CASE WHEN abs(delta) < 0.1 THEN 'stable' ELSE CASE WHEN delta > 0 THEN '+' ELSE '' END
  || CAST(round(CAST(CAST(delta AS VARCHAR) AS DECIMAL(38, 17)), 1) AS VARCHAR) || 'MB' END AS delta_text FROM d""")
def delta_text(spark, sf_dir):
    d = S.delta(events(spark, sf_dir), KEY, ORDER, VAL)
    return d.select(KEY, "event_id", F.round("delta", 4).alias("delta"), "delta_text")


@query("percent_of", "SELECT event_id, CAST(round(CAST(CAST(value / 512 * 100 AS VARCHAR) AS DECIMAL(38, 17)), 1) AS VARCHAR) || '%' "
       "AS pct FROM events")
def percent_of(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", S.percent_of("value").alias("pct"))


@query("resource_report", """SELECT user_id, arg_min(value, (ts, event_id)) AS start_value, max(value) AS peak_value,
  arg_max(value, (ts, event_id)) AS end_value, sround(avg(value), 4) AS average_value, count(*) AS points,
  sround(max(value) / count(*), 4) AS efficiency,
  CASE WHEN max(value) / count(*) < 0.5 THEN 'A' WHEN max(value) / count(*) < 1.0 THEN 'B'
       WHEN max(value) / count(*) < 2.0 THEN 'C' ELSE 'D' END AS grade,
  CASE WHEN arg_max(value, (ts, event_id)) > arg_min(value, (ts, event_id)) * 1.5 THEN 'memory leak detected'
       WHEN arg_max(value, (ts, event_id)) < arg_min(value, (ts, event_id)) * 0.8 THEN 'efficient cleanup'
       ELSE 'normal behavior' END AS trend,
  max(value) / count(*) >= 1.0 AS needs_optimization
FROM events GROUP BY user_id""")
def resource_report(spark, sf_dir):
    r = S.resource_report(events(spark, sf_dir), KEY, ORDER, VAL)
    return r.withColumn("average_value", F.round("average_value", 4)).withColumn("efficiency", F.round("efficiency", 4))


def nullable(spark, sf_dir):
    """Events of which two fifths have no user: NULL is a key like any other."""
    return events(spark, sf_dir).withColumn("user_id", F.when(F.col("event_id") % 5 >= 2, F.col("user_id")))


_NULLABLE = "n AS (SELECT event_id, ts, CASE WHEN event_id % 5 >= 2 THEN user_id END AS user_id, value FROM events)"


@query("rolling_bands_nullkey", f"WITH {_NULLABLE}, " + BANDS_SQL.removeprefix("WITH ").replace("FROM events)", "FROM n)", 1)
       + " SELECT user_id, event_id, sround(baseline, 4) AS baseline, sround(yellow, 4) AS yellow, sround(red, 4) AS red FROM b")
def rolling_bands_nullkey(spark, sf_dir):
    rows = nullable(spark, sf_dir).withColumn("value", F.col("value").cast("decimal(18,2)"))
    b = S.rolling_bands(rows, KEY, ORDER, VAL)
    return b.select(KEY, "event_id", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("baseline", "yellow", "red")])


@query("index_sequential", f"WITH {_NULLABLE} SELECT event_id, user_id, "
       "row_number() OVER (ORDER BY user_id NULLS FIRST, ts, event_id) + 9 AS row_index, "
       "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS user_row FROM n")
def index_sequential(spark, sf_dir):
    """I3 and I2 by key, NULL keys included."""
    rows = nullable(spark, sf_dir).select("event_id", "user_id", "ts")
    out = with_index(rows, "sequential", start=10, file_col=KEY, order_by=ORDER)
    out = with_index(out, "local", file_col=KEY, order_by=ORDER, index_col="user_row")
    return out.select("event_id", KEY, "row_index", "user_row")


@query("sparkline_full", f"""WITH {_NULLABLE}, m AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM n GROUP BY user_id),
c AS (SELECT e.user_id, (row_number() OVER (PARTITION BY e.user_id ORDER BY ts, event_id) - 1) AS pos, {_spark_sql()} AS spark
  FROM n e JOIN m ON e.user_id IS NOT DISTINCT FROM m.user_id)
SELECT user_id, pos // 50 AS part, string_agg(spark, '' ORDER BY pos) AS sparkline FROM c GROUP BY 1, 2""")
def sparkline_full(spark, sf_dir):
    return S.sparkline_full(nullable(spark, sf_dir), KEY, ORDER, VAL, part_rows=50)
