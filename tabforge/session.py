"""Session helpers: building a session for tests/bench and locating shared storage.

Staging data (generated shard folders, lineage cuts) always goes below the
folder the cluster names in ``spark.checkpoint.dir``. We only choose a folder
ourselves when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName("tabforge")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TABFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for staging: ``spark.checkpoint.dir``. Only a local session may go without it: executors elsewhere
    could not read a folder of this machine."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[[^]]*\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tabforge-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


_STAGED: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared staging folder, remembered for :func:`clear_staging`."""
    _STAGED.append(f"{shared_dir(spark)}/tabforge-stage/{name}-{uuid.uuid4().hex[:12]}")
    return _STAGED[-1]


def clear_staging(spark: SparkSession) -> int:
    """Delete the staging folders that this process made; call it when no result built on them is read any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone

