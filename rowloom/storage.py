"""Where intermediate tables are written: the folder every executor can reach."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    ``spark.checkpoint.dir`` wins. Where it is unset a local session gets a
    temporary folder; a cluster session is refused one, because a folder on the
    driver's disk is lost with the driver and unknown to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rowloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Return a fresh path under the shared folder, deleted when the application ends."""
    context = spark.sparkContext
    folder = f"{shared_dir(spark)}/rowloom/{context.applicationId}"
    jvm_path = context._jvm.org.apache.hadoop.fs.Path(folder)
    filesystem = jvm_path.getFileSystem(context._jsc.hadoopConfiguration())
    filesystem.mkdirs(jvm_path)
    filesystem.deleteOnExit(jvm_path)
    return f"{folder}/{name}-{uuid4().hex}"
