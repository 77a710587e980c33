"""Session helpers: building a session for tests/bench and finding shared storage.

The library never hard-codes a storage location. Anything that has to be
materialised (checkpoints that cut lineage, staged files of a run) goes below the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent *and* the master is local (tests, a laptop) do we fall back to a fresh
temporary folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "chartmart") -> SparkSession:
    """Session used by tests and the bench. Production code receives its session."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if _one_machine(master):  # tests and the bench only: keep catalog tables out of the cwd
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="chartmart-warehouse-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _one_machine(master: str) -> bool:
    """``local``, ``local[8]``, ...: driver and executors are one process; ``local-cluster`` is a cluster."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session, setting one only if unset.

    On a cluster the folder must be shared storage named by ``spark.checkpoint.dir``;
    we refuse to invent a machine-local one there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local context: use the setting as given
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _one_machine(sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage before running chartmart jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="chartmart-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder for staged files of one run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/chartmart-stage/{uuid.uuid4().hex}/{name}"


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writers, _before = threading.Lock(), Counter(), {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that runs within go as soon as it ends, not when the driver happens to collect
    its garbage. For writes alone: they are planned once, so nobody reads these shuffles again. Writes run in threads,
    the last one to end puts the setting back."""
    if not spark.conf.isModifiable(_FREE):  # a Spark that does not know it
        yield
        return
    key = id(spark)
    with _lock:
        if not _writers[key]:
            _before[key] = spark.conf.get(_FREE)
        _writers[key] += 1
        spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        with _lock:
            _writers[key] -= 1
            if not _writers[key]:
                spark.conf.set(_FREE, _before.pop(key))
                del _writers[key]


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing upstream joins),
    lets several consumers share one computation, and gives the planner a true size for
    the result (file statistics), so a small result is broadcast and a large one is not.
    ``partition_by`` lays the files out by column value, so equality filters on it prune
    whole directories at scan time. ``compression``: a codec other than the session's, for rows that take much room.
    """
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        w.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)  # known schema: no footer inference
    return back.select(*df.columns)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
