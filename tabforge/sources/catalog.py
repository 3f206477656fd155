"""File catalog of a folder as a DataFrame.

``binaryFile`` lists files in parallel on the cluster; only path, length and
modification time are selected, so file content is never read (column
pruning removes it from the scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_COLUMNS = ("path", "file_name", "base_name", "extension", "parent", "size", "created", "modified")


def suffix_of(name: Column) -> Column:
    """Extension with its dot, like a path suffix: '' when none or only a leading dot."""
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def stem_of(name: Column) -> Column:
    return F.substring(name, F.lit(1), F.char_length(name) - F.char_length(suffix_of(name)))


def with_name_parts(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Derive file_name, base_name, extension, parent from a path column."""
    p = F.col(path_col)
    name = F.regexp_extract(p, r"([^/]*)$", 1)
    return (df.withColumn("file_name", name)
              .withColumn("extension", suffix_of(F.col("file_name")))
              .withColumn("base_name", stem_of(F.col("file_name")))
              .withColumn("parent", F.regexp_extract(p, r"^(.*)/[^/]*$", 1)))


def file_catalog(spark: SparkSession, root: str, recursive: bool = False, types: Sequence[str] | None = None) -> DataFrame:
    """List files under ``root`` with size and times; optional case-insensitive extension filter.

    Columns: path, file_name, base_name, extension, parent, size, created, modified.
    ``created`` is the modification time (file systems expose no creation time).
    """
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", str(recursive).lower())
          .load(root)
          .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")))
    df = with_name_parts(df)
    if types:
        exts = ["." + t.strip().lstrip(".").lower() for t in types]
        df = df.filter(F.lower(F.col("extension")).isin(*exts))
    return df.select("path", "file_name", "base_name", "extension", "parent", "size",
                     F.col("modified").alias("created"), "modified")
