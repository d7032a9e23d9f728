"""Written intermediates.

A staged table cuts lineage, survives the loss of executors, and carries its
real size, so that the planner broadcasts it only when it is small.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_scratch: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="lotwise-"))
    return _local_scratch[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/lotwise/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder once and read it back; it goes when the application ends."""
    path = scratch_path(df.sparkSession, label)
    jvm = df.sparkSession._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
