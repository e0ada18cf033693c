"""Intermediate tables in shared storage.

The folder is the one the cluster names in `spark.checkpoint.dir`. Only a local session without that setting gets a
temporary folder of its own, removed when Python exits. Staged tables in a shared folder stay until its owner clears it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    global _local_base
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="tidewatch-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the frame once and read it back: later plans start from files with known size instead of its lineage."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
