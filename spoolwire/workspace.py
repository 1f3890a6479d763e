"""Shared scratch space for intermediate tables (CSV files, staged topic
records, stream sinks and checkpoints).

Everything that has to survive the loss of an executor is written below the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting
is absent *and* Spark runs in local mode (tests, the bench) is a local
folder chosen and registered as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF_KEY = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """Return the shared folder for intermediate data, setting one only in local mode."""
    root = spark.conf.get(_CONF_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(_CONF_KEY, None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            # getCheckpointDir() appends an application id; keep it, it is shared.
            return current.rstrip("/")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"{_CONF_KEY} is not set: intermediate tables need a folder every executor can reach"
            )
        root = tempfile.mkdtemp(prefix="spoolwire-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared root."""
    return f"{shared_root(spark)}/spoolwire/{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop-compatible) file system, without running a job."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder on its file system, if it exists."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
