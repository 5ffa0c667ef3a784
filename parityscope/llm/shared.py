"""Tables and files that one step writes and later steps read.

They lie in the folder named by ``spark.checkpoint.dir``, which the driver and all
executors share, so a lost executor costs at most the tasks it was running.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Least seconds between two collections of the driver's garbage, and the share of time
#: that they may take.
_RELEASE_SECONDS, _RELEASE_SHARE = 2.0, 0.05
_next_release = 0.0


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends.

    Only a local master may go without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_by_call = spark.sparkContext.getCheckpointDir()
        if set_by_call:
            folder = set_by_call
        elif spark.sparkContext.master.startswith("local"):
            folder = _own_folder()
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session beside this one, with its settings and further ones. These hold for the
    tables that it reads, while the caller's session stays as it is."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def written(df: DataFrame, name: str, reader: SparkSession | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write a table and return it as read again: its lineage ends here.

    ``reader`` is the session that reads it, the table's own by default; ``options`` are
    further ones of the writer.

    Nothing needs the shuffle files behind it any more. Spark deletes them once the
    driver has collected its garbage, which is asked for here, though not more than once in
    ``_RELEASE_SECONDS``, or later where it takes long: a small heap may not do so for the
    whole job, whose disks would hold the shuffles of all its steps. The heap also shrinks
    to what is in use, else it grows by the plans of many short steps.
    """
    global _next_release
    spark, schema = df.sparkSession, df.schema
    path = shared_path(spark, name)
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    began = time.monotonic()
    if began >= _next_release:
        spark._jvm.System.gc()
        now = time.monotonic()
        _next_release = now + max(_RELEASE_SECONDS, (now - began) / _RELEASE_SHARE)
    return (reader or spark).read.schema(schema).parquet(path)
