"""Intermediate storage that every executor can reach.

The shared folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
local session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="telmart-"))
    return context.getCheckpointDir()


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
