"""Where queries put tables that they write on the way."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that must be written on the way, removed at the end.

    It lies in the shared folder of ``spark.checkpoint.dir``, or in the one that was set by
    ``setCheckpointDir``. Only a local master may go without; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        _delete_at_exit(spark, path)
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="parityscope-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder}/{name}"
