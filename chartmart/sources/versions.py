"""Immutable versions below one folder: ``<prefix>=<id>``, complete once the writer's ``_SUCCESS`` is there.

Nothing is ever switched over: a reader takes the complete versions it wants, and a job that
is run again rewrites its own version and no other. Only a folder that is not there counts as
empty; any other error is raised.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def complete(spark: SparkSession, folder: str, prefix: str, last: str = "") -> list[str]:
    """Ids of the complete versions, as text, unordered. ``last`` is the subfolder written last, if any."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), f"{last}/_SUCCESS" if last else "_SUCCESS")
        if name.startswith(f"{prefix}=") and fs.exists(done):
            out.append(name[len(prefix) + 1:])
    return out
