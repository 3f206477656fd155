"""I2/I3 numbering and L8-L14 chunked windows against plain window functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.operators import series as S
from tabforge.operators.indexing import with_index


def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id", "value")


def test_key_numbering_matches_row_number(spark):
    ev = events(spark)
    got = with_index(ev, "local", file_col="user_id", order_by=["ts", "event_id"], index_col="pos")
    want = ev.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1)
    j = got.join(want, "event_id")
    assert j.count() == ev.count()
    assert j.filter(F.col("pos") != F.col("rn")).count() == 0
    seq = with_index(ev, "sequential", file_col="user_id", order_by=["ts", "event_id"], index_col="pos")
    assert sorted(r.pos for r in seq.collect()) == list(range(ev.count()))


def test_chunked_windows_with_small_chunks_are_exact(spark):
    ev = events(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    small = S.rolling_bands(ev, "user_id", ["ts", "event_id"], "value", n=10, chunk_rows=12)
    ref = ev.withColumn("m", F.avg("value").over(w.rowsBetween(-9, 0))).withColumn(
        "n", F.count("*").over(w.rowsBetween(-9, 0)))
    j = small.join(ref, "event_id").filter(F.col("n") >= 5)
    assert j.filter(F.abs(F.col("baseline") - F.col("m")) > 1e-9).count() == 0
    d = S.delta(ev, "user_id", ["ts", "event_id"], "value", chunk_rows=7)
    ref2 = ev.withColumn("d", F.col("value") - F.coalesce(F.lag("value").over(w), F.col("value")))
    assert d.join(ref2, "event_id").filter(F.abs(F.col("delta") - F.col("d")) > 1e-9).count() == 0


def test_band_and_spark_char(spark):
    df = spark.createDataFrame([(1.0, 0.0, 8.0), (8.0, 0.0, 8.0), (3.0, 3.0, 3.0)], "v DOUBLE, lo DOUBLE, hi DOUBLE")
    got = [r[0] for r in df.select(S.spark_char(F.col("v"), F.col("lo"), F.col("hi"))).collect()]
    assert got == ["▂", "█", "▄"]
    assert S.classify_band is not None


def test_partitions_stay_even_with_null_and_hot_keys(spark):
    from tabforge.operators import ordering as O
    df = spark.range(0, 60_000, 1, 6).select(
        F.expr("CASE WHEN id % 10 < 4 THEN NULL WHEN id % 10 < 9 THEN 7 ELSE id END").alias("k"),
        F.expr("CASE WHEN id % 2 = 0 THEN id % 5 END").alias("o"), "id")
    rows = O.placed(df, [F.col("k"), F.col("o")], parts=12)
    sizes = [r["count"] for r in rows.groupBy(O.PART).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    got = O.number(df, [F.col("k"), F.col("o"), F.col("id")], by="k", out="n", parts=12)
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")) - 1)
    assert got.join(want, "id").where("n <> w").count() == 0 and got.where("n IS NULL").count() == 0


def test_hot_key_join_can_be_split(spark):
    df = spark.range(0, 40_000, 1, 4).select(F.expr("CASE WHEN id % 2 = 0 THEN 0 ELSE id END").alias("k"), F.col("id").cast("double").alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(old, ("-1", "40", "1k", "1k", "2")):
            spark.conf.set(k, v)
        out = S.text_bar(df, "k", "v")
        assert out.count() == 40_000
        out.write.format("noop").mode("overwrite").save()
        rows = out.select("bar")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_whole_sparkline_in_parts(spark):
    df = spark.createDataFrame([("a", i, float(i % 8)) for i in range(25)] + [(None, 1, 1.0)], "k string, t int, v double")
    got = {(r.k, r.part): r.sparkline for r in S.sparkline_full(df, "k", ["t"], "v", part_rows=10).collect()}
    assert got[("a", 0)] + got[("a", 1)] + got[("a", 2)] == ("".join(S.SPARK_LEVELS) * 4)[:25] and got[(None, 0)] == "▄"


def test_partitions_follow_the_input_of_a_join(spark):
    """The optimizer takes a join for the product of both sides; partitions must not grow with that."""
    from tabforge.operators import ordering as O
    rows = O.write_and_read(spark.range(60_000).select("id", F.col("id").cast("string").alias("k")), "join-rows")
    joined = O.join_on(rows, rows.select("k", F.col("id").alias("other")), ["k"])
    assert O.partitions_for(joined) == O.partitions_for(rows) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert O.partitions_for(O.join_on(joined, rows.select("k", F.col("id").alias("third")), ["k"])) == O.partitions_for(rows)
    old, O.PARTITION_BYTES = O.PARTITION_BYTES, 10_000
    try:  # but with the rows
        assert O.partitions_for(rows) > 20 and O.partitions_for(rows) <= O.partitions_for(joined) <= 3 * O.partitions_for(rows)
    finally:
        O.PARTITION_BYTES = old
    got = O.number(joined, [F.col("k"), F.col("id")], out="n")
    assert got.count() == 60_000 and got.agg(F.max("n")).first()[0] == 59_999
