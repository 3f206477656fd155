"""Folder scans: CSV lines to cells.

Files of one folder disagree about their headers, so lines are scanned once and written with their file and place;
headers, cells and failures all come from those files. A *layout* is a distinct header; only the distinct layouts
reach the driver.
"""

from __future__ import annotations

import csv
import io
import os
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import write_and_read
from .quoted import line_ends, whole_records

# --- fixed values ----------------------------------------------------------
SUPPORTED_TYPES = ("csv", "xlsx", "json")
CORRUPT = "_corrupt_record"
# Accepted reader options and their aliases.
CSV_OPTION_ALIASES = {
    "sep": "sep", "delimiter": "sep", "encoding": "encoding", "quotechar": "quote", "quote": "quote",
    "escape": "escape", "na_values": "nullValue", "na_rep": "nullValue", "nullvalue": "nullValue",
    "comment": "comment", "dateformat": "dateFormat", "timestampformat": "timestampFormat",
    "ignoreleadingwhitespace": "ignoreLeadingWhiteSpace", "ignoretrailingwhitespace": "ignoreTrailingWhiteSpace",
    "multiline": "multiLine", "linesep": "lineSep",
}
JSON_OPTION_ALIASES = {
    "encoding": "encoding", "multiline": "multiLine", "dateformat": "dateFormat",
    "timestampformat": "timestampFormat", "primitivesasstring": "primitivesAsString",
}
WRITE_OPTION_ALIASES = {
    "sep": "sep", "delimiter": "sep", "encoding": "encoding", "na_rep": "nullValue", "nullvalue": "nullValue",
    "quotechar": "quote", "quote": "quote", "header": "header", "compression": "compression",
}

JSON_WRITE_ALIASES = {"encoding": "encoding", "compression": "compression", "dateformat": "dateFormat", "timestampformat": "timestampFormat",
                      "ignorenullfields": "ignoreNullFields", "linesep": "lineSep"}


def normalize_types(types: str | Sequence[str] | None) -> list[str]:
    """None -> all supported; strip dots, lower-case; unsupported -> error."""
    if types is None:
        return list(SUPPORTED_TYPES)
    if isinstance(types, str):
        types = [t for t in types.split(",")]
    out = []
    for t in types:
        t = t.strip().lstrip(".").lower()
        if not t:
            continue
        if t not in SUPPORTED_TYPES:
            raise ValueError(f"unsupported file type {t!r}; supported: {', '.join(SUPPORTED_TYPES)}")
        if t not in out:
            out.append(t)
    return out


def filter_options(options: Mapping | None, aliases: Mapping[str, str]) -> dict[str, str]:
    """Keep only options valid for the format, mapping pandas-style names."""
    out = {}
    for k, v in (options or {}).items():
        key = aliases.get(str(k).lower())
        if key is not None:
            out[key] = str(v).lower() if isinstance(v, bool) else str(v)
    return out


def ext_glob(ext: str) -> str:
    """Case-insensitive glob for one extension (pathGlobFilter is case-sensitive)."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)


def qualify(spark: SparkSession, root: str) -> str:
    """Fully qualified folder URI the way scans report ``_metadata.file_path``."""
    if "://" in root or root.startswith("file:"):
        return root.rstrip("/")
    return "file:" + os.path.abspath(root).rstrip("/")


def relative_path(path_col, root_uri: str):
    """Path relative to the input folder (Q10: independent of the working dir)."""
    prefix = root_uri + "/"
    alt = prefix.replace("file:", "file://", 1) if prefix.startswith("file:") and not prefix.startswith("file://") else prefix
    return (F.when(F.startswith(path_col, F.lit(prefix)), F.substring(path_col, len(prefix) + 1, 1 << 30))
            .when(F.startswith(path_col, F.lit(alt)), F.substring(path_col, len(alt) + 1, 1 << 30))
            .otherwise(path_col))


def csv_options(options: Mapping | None) -> dict[str, str]:
    opts = {"sep": ",", "quote": '"', "escape": "\\", "mode": "PERMISSIVE"}
    return opts | filter_options(options, CSV_OPTION_ALIASES)


def raw_lines(lines: DataFrame, root_uri: str, options: Mapping | None = None) -> DataFrame:
    """A text scan (batch or stream) -> (source_file, blk, line, skip); ``skip`` marks blank lines and comments."""
    opts = csv_options(options)
    line = F.col("value")
    if opts.get("encoding", "UTF-8").upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        line = F.decode(F.col("value").cast("binary"), opts["encoding"])
    df = lines.select(relative_path(F.col("_metadata.file_path"), root_uri).alias("source_file"),
                      F.col("_metadata.file_block_start").alias("blk"), F.regexp_replace(line, "^\ufeff", "").alias("line"))
    skip = F.trim("line") == ""
    if opts.get("comment"):
        skip = skip | F.startswith("line", F.lit(opts["comment"]))
    return df.withColumn("skip", skip)


def csv_lines(lines: DataFrame, root_uri: str, options: Mapping | None = None) -> DataFrame:
    """A text scan (batch or stream) -> (source_file, blk, mid, line, open): lines that hold data, numbered where they
    stand; ``open`` marks lines that end inside a quoted field.

    Blank lines and lines that begin with the comment character are dropped before they are numbered, so ``mid`` has no
    gaps inside a split.
    """
    df = raw_lines(lines, root_uri, options).where("NOT skip").drop("skip")
    return df.select("source_file", "blk", F.monotonically_increasing_id().alias("mid"), "line", line_ends(F.col("line"), csv_options(options))[0].alias("open"))


def csv_records(scan: DataFrame, lines: DataFrame, root_uri: str, options: Mapping | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(records, broken files) of written ``lines``: files in which a line ends inside a quoted field are read once more from
    ``scan`` and cut into whole records; None where there is no such file."""
    files = write_and_read(lines.where("open").select("source_file").distinct(), "quoted-files")
    if files.isEmpty():
        return lines.drop("open"), None
    again = raw_lines(scan, root_uri, options).withColumn("mid", F.monotonically_increasing_id())
    records, broken = whole_records(again.join(files, "source_file", "left_semi"), csv_options(options))
    return write_and_read(lines.drop("open").join(files, "source_file", "left_anti").unionByName(records), "records"), broken


def text_scan(spark: SparkSession, root: str, ext: str, recursive: bool = True) -> DataFrame | None:
    """The lines of all files with an extension; None where there is no such file."""
    try:
        df = (spark.read.format("text").option("recursiveFileLookup", str(recursive).lower())
              .option("pathGlobFilter", ext_glob(ext)).load(root))
        return df.select("value", "_metadata") if df.inputFiles() else None
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "No such file" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def files_of(spark: SparkSession, root: str, ext: str, recursive: bool = True) -> DataFrame | None:
    """The paths of all files with an extension, empty ones too; None where there is no such file."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", ext_glob(ext)).load(root)
    found = df.select(F.col("_metadata.file_path").alias("path"))
    listed = df.inputFiles()
    if len(listed) > found.count():  # a scan leaves out files without bytes
        found = found.unionByName(spark.createDataFrame([(re.sub("^file:///", "file:/", p),) for p in listed], "path STRING")).distinct()
    return found if listed else None


def _array_of(line, width: int, options: Mapping | None):
    """The first ``width`` fields of a line as an array, NULL where there are fewer."""
    opts = {k: v for k, v in csv_options(options).items() if k not in ("encoding", "comment", "multiLine", "lineSep")}
    parsed = F.from_csv(line, ", ".join(f"c{i} STRING" for i in range(width)), opts)
    return F.array(*[parsed.getField(f"c{i}") for i in range(width)])


def parse_header(line: str, options: Mapping | None = None) -> list[str]:
    """Header line -> column names by the caller's separator, quote and escape (driver side, once for each distinct line)."""
    opts = csv_options(options)
    escape = opts["escape"] if opts["escape"] != opts["quote"] else None
    quote = {"quotechar": opts["quote"]} if opts["quote"] else {"quoting": csv.QUOTE_NONE}
    row = next(csv.reader(io.StringIO(line), delimiter=opts["sep"][:1], escapechar=escape, **quote), []) if len(opts["sep"]) == 1 else line.split(opts["sep"])
    return [c.strip() for c in row]


def headers_of(lines: DataFrame, options: Mapping | None = None) -> DataFrame:
    """lines -> (source_file, blk0, mid0, header array, layout) of each file's first line. Only the distinct first lines
    reach the driver, where they are parsed."""
    first = lines.groupBy("source_file").agg(F.min_by(F.struct("blk", "mid", "line"), F.struct("blk", "mid")).alias("f"))
    first = first.select("source_file", F.col("f.blk").alias("blk0"), F.col("f.mid").alias("mid0"), F.col("f.line").alias("line"))
    known = [(r["line"], parse_header(r["line"], options)) for r in first.select("line").distinct().collect()]
    names = lines.sparkSession.createDataFrame(known, "line STRING, header ARRAY<STRING>")
    return first.join(names, "line").select("source_file", "blk0", "mid0", "header", F.xxhash64("header").alias("layout"))


def csv_cells(lines: DataFrame, headers: DataFrame, options: Mapping | None = None) -> DataFrame:
    """(source_file, sheet_name, blk, mid, layout, cells, failed): data lines of written ``lines`` by their file's header.

    ``failed`` marks a line with more fields than its header (Q28); shorter ones are padded with NULL.
    """
    width = (headers.agg(F.max(F.size("header"))).first()[0] or 0) + 1
    n = F.size("header")
    rows = lines.join(headers, "source_file").where("NOT (blk = blk0 AND mid = mid0)").withColumn("all", _array_of(F.col("line"), width, options))
    return rows.select("source_file", F.lit(None).cast("string").alias("sheet_name"), "blk", "mid", "layout",
                       F.slice("all", 1, n).alias("cells"), F.get("all", n).isNotNull().alias("failed"))


def layouts_of(headers: DataFrame) -> list[tuple[int, list[str]]]:
    """Distinct layouts with their column names, in the order of their first files."""
    rows = headers.groupBy("layout").agg(F.first("header").alias("header"), F.min("source_file").alias("first")).orderBy("first").collect()
    return [(r["layout"], dedupe_names(r["header"])) for r in rows]


def layout_frame(cells: DataFrame, layout: int, columns: Sequence[str]) -> DataFrame:
    """The rows of one layout with named STRING columns, ``source_file`` and the place columns."""
    return cells.where(F.col("layout") == layout).select(
        *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)], "source_file",
        F.col("source_file").alias("__file"), F.col("blk").alias("__blk"), F.col("mid").alias("__mid"),
        F.col("sheet_name").alias("__sheet"))


def dedupe_names(names: Sequence[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        n = n or "unnamed"
        if n in seen:
            seen[n] += 1
            out.append(f"{n}.{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out
