"""Incremental folder ingest with Structured Streaming.

The lines of newly arrived CSV files come as a file stream; ``Trigger.AvailableNow`` takes what arrived since the last
run (the checkpoint lists the files seen). A file is one unit of the stream, so each batch holds whole files and takes
the batch path: headers by file, one layout for each distinct header, files with a bad line left out whole, lineage
kept. A batch writes a folder of its own name, so a batch that is run again after a failure replaces what it wrote.

:func:`ingest_folder` takes files of every type. Its stream lists the new files only; a batch reads them as the folder
path does. The schema grows: a batch merges what it finds with the schema of the batch before it and writes the result
beside its data; a ledger of rows gives each batch the number its rows begin with. Both are read from the batches
before, so a batch that is run again gives the same.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import harmonize as H
from ..operators.ordering import write_and_read
from ..operators.indexing import POS_COLS, with_index
from ..plans.harmonize_folder import HarmonizeConfig, _normalise, csv_frames, harmonize_paths
from ..sources.folder import csv_lines, csv_records, ext_glob, normalize_types, qualify


def ingest_stream(spark: SparkSession, root: str, sink: str, checkpoint: str, types: Mapping[str, str],
                  config: HarmonizeConfig | None = None, wait: bool = True):
    """Start (and by default finish) one AvailableNow run over the CSV files below ``root``; returns the query.

    ``types`` ({column: dtype label}) is the sink's schema: a column that a layout lacks is NULL, others are dropped.
    Rows go to ``sink``/data, a row for each file (source_file, status, rows) to ``sink``/files.
    """
    cfg = config or HarmonizeConfig()
    schema, root_uri = H.to_struct(types), qualify(spark, root)
    stream = (spark.readStream.format("text").option("recursiveFileLookup", str(cfg.recursive).lower())
              .option("pathGlobFilter", ext_glob("csv")).load(root).select("value", "_metadata"))

    def batch(rows: DataFrame, number: int) -> None:
        lines = write_and_read(csv_lines(rows, root_uri, cfg.read_options), "ingest-lines")
        seen, frames = csv_frames(*csv_records(rows, lines, root_uri, cfg.read_options), cfg.read_options)
        status = write_and_read(seen.groupBy("source_file").agg(F.max("failed").alias("bad"), F.sum("rows").alias("rows")), "ingest-status")
        bad = status.where("bad").select("source_file")
        out = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("source_file", T.StringType())]))
        for df, raw in frames:
            good = _normalise(df, raw, cfg).join(bad, "source_file", "left_anti")
            out = out.unionByName(H.align_to_schema(good, schema, keep=["source_file"]))
        out.write.mode("overwrite").parquet(f"{sink}/data/batch={number}")
        (status.select("source_file", F.when(F.col("bad"), "failed").otherwise("ok").alias("status"),
                       F.when(F.col("bad"), 0).otherwise(F.col("rows")).cast("bigint").alias("rows"))
         .write.mode("overwrite").parquet(f"{sink}/files/batch={number}"))

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        q.awaitTermination()
    return q


SCHEMA_LOG, LEDGER = "batch BIGINT, position INT, column_name STRING, dtype STRING", "batch BIGINT, start BIGINT, rows BIGINT"


def _log(spark: SparkSession, sink: str, name: str, ddl: str, before: int | None = None) -> DataFrame:
    """Rows of a log that earlier batches wrote; none before the first."""
    folders = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    try:
        found = folders.load(f"{sink}/{name}").select("path").limit(1).count()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = 0
    log = spark.read.schema(ddl).option("recursiveFileLookup", "true").parquet(f"{sink}/{name}") if found else spark.createDataFrame([], ddl)
    return log.where(F.col("batch") < before) if before is not None else log


def _schema_at(log: DataFrame) -> dict[str, str]:
    last = log.agg(F.max("batch")).first()[0]
    return {r["column_name"]: r["dtype"] for r in log.where(F.col("batch") == last).orderBy("position").collect()} if last is not None else {}


def ingest_folder(spark: SparkSession, root: str, sink: str, checkpoint: str, config: HarmonizeConfig | None = None, wait: bool = True,
                  files_per_batch: int = 1000):
    """Start (and by default finish) one AvailableNow run over new CSV, JSON and Excel files below ``root``; returns the query.

    Columns and types are found in the files and widened from run to run; rows are numbered over all batches where the
    configuration's index mode is ``sequential``, from 0 in each file where it is ``local``. Read with
    :func:`read_ingested`; ``sink``/files has a row for each file (source_file, status, rows).
    """
    cfg = config or HarmonizeConfig()
    globs = [ext_glob(t)[2:] for t in normalize_types(cfg.types)]
    stream = (spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
              .option("recursiveFileLookup", str(cfg.recursive).lower()).option("pathGlobFilter", "*.{" + ",".join(globs) + "}")
              .option("maxFilesPerTrigger", files_per_batch).load(root).select("path"))

    def batch(rows: DataFrame, number: int) -> None:
        paths = [r["path"] for r in rows.collect()]  # files_per_batch at most
        known = _schema_at(_log(spark, sink, "schema", SCHEMA_LOG, number))
        res = harmonize_paths(spark, paths, qualify(spark, root), cfg, known)
        start = _log(spark, sink, "ledger", LEDGER, number).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        data = with_index(res.data, cfg.index_mode, cfg.index_start + (start if cfg.index_mode == "sequential" else 0), "source_file", index_col=cfg.index_col)
        data.drop(*[c for c in POS_COLS if c in data.columns]).write.mode("overwrite").parquet(f"{sink}/data/batch={number}")
        count = spark.read.parquet(f"{sink}/data/batch={number}").count()
        res.file_status.write.mode("overwrite").parquet(f"{sink}/files/batch={number}")
        spark.createDataFrame([(number, i, c, t) for i, (c, t) in enumerate(res.types.items())], SCHEMA_LOG).write.mode("overwrite").parquet(f"{sink}/schema/batch={number}")
        spark.createDataFrame([(number, start, count)], LEDGER).write.mode("overwrite").parquet(f"{sink}/ledger/batch={number}")

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        q.awaitTermination()
    return q


def read_ingested(spark: SparkSession, sink: str) -> DataFrame:
    """All rows that :func:`ingest_folder` has written, in the schema of the last batch. Batches of one schema are read together."""
    log = _log(spark, sink, "schema", SCHEMA_LOG)
    types = _schema_at(log)
    same = log.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("position", "column_name", "dtype"))).alias("s"))
    out = None
    for r in same.groupBy("s").agg(F.sort_array(F.collect_list("batch")).alias("b")).orderBy(F.col("b")[0]).collect():
        part = spark.read.parquet(*[f"{sink}/data/batch={b}" for b in r["b"]])
        keep = [c for c in part.columns if c not in {x["column_name"] for x in r["s"]}]
        part = H.align_to_schema(part, H.to_struct(types), keep=keep)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
