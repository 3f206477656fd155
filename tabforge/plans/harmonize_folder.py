"""Folder harmonisation end to end.

Every file is parsed once into tables below the shared folder (lines and cells of CSV files, cells of workbooks, rows
of JSON documents). Headers, failures, types and split counts come from these tables; then, lazily: normalise, alias
and split (H1-H3), align with try_cast (H7), union (H8), number (I1-I3). Work grows with the rows and once with the
number of layouts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import harmonize as H
from ..operators.indexing import POS_COLS, with_index
from ..operators.ordering import write_and_read
from ..sources import excel, jsonsrc
from ..sources import folder as S


@dataclass
class HarmonizeConfig:
    schema_map: Mapping | None = None
    to_lower: bool = True
    spaces_to_underscores: bool = True
    split_names: bool = True
    fill_gaps: bool = False
    index_mode: str | None = "sequential"
    index_start: int = 0
    index_col: str = "row_index"
    types: Sequence[str] | str | None = None
    recursive: bool = True
    columns: Sequence[str] | None = None          # H6: predefined columns, skip detection
    column_types: Mapping[str, str] | None = None
    on_error: str = "skip"                         # S10: skip | fail
    read_options: Mapping | None = None
    json_object_root: bool | None = None           # S6 for .json files; None: as each file's root is
    sheets: Sequence[str | int] | None = (0,)      # S4: sheets of .xlsx files by place or name; None: all


@dataclass
class HarmonizeResult:
    data: DataFrame
    types: dict[str, str]
    file_status: DataFrame
    layouts: int = 0


def schema_from_columns(columns: Sequence[str] | str, types: Mapping[str, str] | None = None) -> dict[str, str]:
    """H6: ordered {column: dtype label}; default ``object`` (Q5: types kept apart)."""
    if isinstance(columns, str):
        columns = [c.strip() for c in columns.split(",") if c.strip()]
    return {c: (types or {}).get(c, "object") for c in columns}


def _normalise(df: DataFrame, raw_cols: Sequence[str], cfg: HarmonizeConfig) -> DataFrame:
    """``raw_cols`` names the first columns of ``df``; they are taken by place, as names may differ in case only."""
    plan = H.rename_plan(raw_cols, cfg.schema_map, cfg.to_lower, cfg.spaces_to_underscores)
    keep = df.columns[len(raw_cols):]
    df = df.toDF(*[f"__c{i}" for i in range(len(raw_cols))], *keep)
    at = {c: F.col(f"__c{i}") for i, c in enumerate(raw_cols)}
    cols = [F.coalesce(*[at[s] for s in sources]).alias(name) if len(sources) > 1 else at[sources[0]].alias(name) for name, sources in plan]
    out = df.select(*cols, *[F.col(f"`{k}`") for k in keep])
    if cfg.split_names:
        out = H.split_name(out, fill_gaps=cfg.fill_gaps)
    return out


def csv_frames(lines: DataFrame, broken: DataFrame | None, options: Mapping | None) -> tuple[DataFrame, list[tuple[DataFrame, list[str]]]]:
    """(status rows, [(frame, raw columns)]) of written CSV records; ``broken`` files have none that can be trusted."""
    headers = write_and_read(S.headers_of(lines, options), "headers")
    cells = S.csv_cells(lines, headers, options)
    cells = write_and_read(cells, "cells")
    # a file of a header alone has no cells, but it was read
    seen = cells.select("source_file", "failed", F.lit(1).cast("long").alias("rows")).unionByName(
        headers.select("source_file", F.lit(False).alias("failed"), F.lit(0).cast("long").alias("rows")))
    if broken is not None:
        seen = seen.unionByName(broken.select("source_file", F.lit(True).alias("failed"), F.lit(0).cast("long").alias("rows")))
    return seen, [(S.layout_frame(cells, k, cols).drop("__sheet"), cols) for k, cols in S.layouts_of(headers)]


def _group_frames(spark: SparkSession, root: str | list[str], root_uri: str, cfg: HarmonizeConfig):
    """(status rows, [normalised frame]) of all files below a folder, or of given files; a status row is (source_file,
    failed, rows)."""
    types = S.normalize_types(cfg.types)
    seen, frames = [], []
    if "csv" in types and (text := S.text_scan(spark, root, "csv", cfg.recursive)) is not None:
        lines = write_and_read(S.csv_lines(text, root_uri, cfg.read_options), "lines")
        status, found = csv_frames(*S.csv_records(text, lines, root_uri, cfg.read_options), cfg.read_options)
        seen.append(status)
        frames += [_normalise(df, raw, cfg) for df, raw in found]
    if "xlsx" in types:
        rows = write_and_read(excel.read_excel_folder(spark, root, cfg.sheets, cfg.recursive), "workbooks")
        cells, headers, status = excel.excel_cells(rows, root_uri)
        if not rows.isEmpty():
            seen.append(status)
            for k, cols in S.layouts_of(headers):
                frames.append(_normalise(S.layout_frame(cells, k, cols).withColumnRenamed("__sheet", "sheet_name"), cols, cfg))
    if "json" in types:
        status, found = jsonsrc.json_frames(spark, root, root_uri, cfg.recursive, cfg.json_object_root, cfg.read_options)
        if status is not None:
            seen.append(status)
            frames += [_normalise(df, raw, cfg) for df, raw in found]
    return seen, frames


def _data_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("source_file", "sheet_name") and c not in POS_COLS]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def harmonize_folder(spark: SparkSession, root: str, config: HarmonizeConfig | None = None) -> HarmonizeResult:
    cfg = config or HarmonizeConfig()
    res = harmonize_paths(spark, root, S.qualify(spark, root), cfg)
    res.data = with_index(res.data, cfg.index_mode, cfg.index_start, "source_file", index_col=cfg.index_col)
    return res


def harmonize_paths(spark: SparkSession, root: str | list[str], root_uri: str, cfg: HarmonizeConfig, known: Mapping[str, str] | None = None) -> HarmonizeResult:
    """Rows that are not numbered yet, with their place columns. ``known`` is a schema found earlier; what is found here widens it."""
    seen, frames = _group_frames(spark, root, root_uri, cfg)
    if not seen:
        raise FileNotFoundError(f"no processable files under {root}")
    status = (_union(seen).groupBy("source_file").agg(F.max("failed").alias("failed"), F.sum("rows").alias("rows"))
              .select("source_file", F.when(F.col("failed"), F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
                      F.when(F.col("failed"), F.lit(0)).otherwise(F.col("rows")).cast("bigint").alias("rows")))
    status = write_and_read(status, "status")
    failed = status.where("status = 'failed'").select("source_file")
    bad = failed.limit(1).collect()
    if bad and cfg.on_error == "fail":
        raise ValueError(f"malformed file: {bad[0]['source_file']}")
    if bad:
        frames = [df.join(failed, "source_file", "left_anti") for df in frames]

    if cfg.columns is not None:
        merged = schema_from_columns(cfg.columns, cfg.column_types)
    else:  # one profiling job for all layouts
        profiles = H.profile_many(frames, [_data_cols(df) for df in frames]) if frames else []
        merged = H.merge_schemas([*([known] if known else []), *profiles])
    for c, t in H.schema_map_types(cfg.schema_map).items():
        if c in merged:
            merged[c] = t if t in H.TYPE_ORDER else merged[c]
    if any("sheet_name" in d.columns for d in frames):
        merged.setdefault("sheet_name", "object")
    schema = H.to_struct(merged)
    keep = ["source_file", *POS_COLS]
    if frames:
        data = _union([H.align_to_schema(df, schema, keep=keep) for df in frames])
    else:
        data = H.align_to_schema(spark.createDataFrame([], "source_file STRING, __file STRING, __blk BIGINT, __mid BIGINT"), schema, keep=keep)
    return HarmonizeResult(data=data, types=merged, file_status=status, layouts=len(frames))


def detect_schema(spark: SparkSession, root: str, config: HarmonizeConfig | None = None) -> DataFrame:
    """H4 as a table: one row per (column, dtype) of the merged schema, in order."""
    cfg = config or HarmonizeConfig()
    cfg = HarmonizeConfig(**{**cfg.__dict__, "index_mode": "none"})
    res = harmonize_folder(spark, root, cfg)
    rows = [(i, c, t) for i, (c, t) in enumerate(res.types.items())]
    rows.append((len(rows), "source_file", "object"))
    return spark.createDataFrame(rows, "position BIGINT, column_name STRING, dtype STRING")


def check_inputs(spark: SparkSession, catalog: DataFrame, config: HarmonizeConfig | None = None) -> DataFrame:
    """Pre-run checks as rows (severity, message).

    Data checks are aggregates over the file catalog (S1); configuration checks
    are evaluated on the driver and unioned in as literal rows.
    """
    cfg = config or HarmonizeConfig()
    types = S.normalize_types(cfg.types)
    stats = catalog.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.lower(F.col("extension")).isin(*types)).alias("processable"),
        F.count_if(F.col("size") == 0).alias("empty"),
    )
    checks = stats.select(F.explode(F.array(
        F.when(F.col("n") == 0, F.struct(F.lit("error").alias("severity"), F.lit("input folder has no files").alias("message"))),
        F.when((F.col("n") > 0) & (F.col("processable") == 0),
               F.struct(F.lit("error").alias("severity"),
                        F.lit("no processable files (" + ", ".join(types) + ")").alias("message"))),
        F.when(F.col("empty") > 0, F.struct(F.lit("warning").alias("severity"),
                                            F.format_string("%d empty files will be skipped", F.col("empty")).alias("message"))),
    )).alias("c")).filter(F.col("c").isNotNull()).select("c.*")
    msgs = []
    if cfg.columns is not None:
        cols = [c.strip() for c in (cfg.columns.split(",") if isinstance(cfg.columns, str) else cfg.columns)]
        dups = sorted({c for c in cols if cols.count(c) > 1})
        if dups:
            msgs.append(("error", "duplicate columns: " + ", ".join(dups)))
    for c, t in (cfg.column_types or {}).items():
        if t not in H.TYPE_ORDER:
            msgs.append(("warning", f"unknown type {t!r} for column {c!r}; treated as object"))
    if cfg.index_mode not in (None, "none", "local", "sequential"):
        msgs.append(("error", f"unknown index mode {cfg.index_mode!r}"))
    if msgs:
        checks = checks.unionByName(spark.createDataFrame(msgs, "severity STRING, message STRING"))
    return checks
