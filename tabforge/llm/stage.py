"""Written intermediate tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path


class Stage:
    """A folder of Parquet tables below ``spark.checkpoint.dir`` for one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = staging_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it as read back from the files."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """Tasks for ``size`` units at ``each`` units a task, never under the session's shuffle partitions."""
    return max(shuffle_partitions(spark), -(-int(size) // each))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: Keys that may be broadcast, 16 bytes each in a hashed relation; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def only(rows: DataFrame, keys: DataFrame, key: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """Rows whose ``key`` is in ``keys``, a written table of long keys (or is not, with ``how="left_anti"``). Up to
    ``BROADCAST_KEYS`` keys go to every executor, so that wide rows stay where they are."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, key, how)
