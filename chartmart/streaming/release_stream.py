"""Structured Streaming forms of the recurring release load.

The reference's "real-time" load is a daily batch; the Spark form is a file stream that
picks up newly landed files, so the same job serves a backfill (``availableNow``) and a
continuous feed. Results are exact whatever the arrival order and the number of batches: what
has been emitted is kept in a table, not in state that a watermark expires.

* ``stream_keep_one``     : one row per key over all batches. Each micro-batch is reduced to one
                            row per key, anti-joined with the keys of earlier batches and
                            written to a part of its own.
* ``stream_dedup``        : ``stream_keep_one`` over files of rows.
* ``stream_release_load`` : landed page JSON -> flat items -> enrichment -> typed rows -> keep one.
* ``stream_upsert``       : ``foreachBatch`` applies the batch MERGE to the dimension and writes a
                            new version per batch.

Parts and versions are named after the batch and complete once written (``sources.versions``).
A batch reads those of smaller batches only and rewrites its own, so a retried batch, a
restart, or a crash at any point leaves the same tables. A folder belongs to one checkpoint.
With ``available_now=False`` the running query is returned, for the caller to watch and stop.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chartmart.operators.dedup import first_per_key
from chartmart.sources.versions import complete


def _source(spark: SparkSession, in_dir: str, schema: T.StructType, fmt: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(in_dir)


def _run(stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
    if available_now:
        q.awaitTermination()
    return q


def parts(spark: SparkSession, out_dir: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The rows of all complete parts (of those of batches smaller than ``before``)."""
    ids = sorted(int(b) for b in complete(spark, out_dir, "batch"))
    paths = [f"{out_dir}/batch={b}" for b in ids if before is None or b < before]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def stream_keep_one(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str,
                    keys: Sequence[str], order: Sequence[str] | None = None, available_now: bool = True) -> StreamingQuery:
    """The first row per key of ``transform`` of every micro-batch: of the earliest batch that has
    the key and, within it, the smallest in ``order`` (all other columns by default). No row of a
    new key is dropped, however late, and no key is written twice. NULL key parts are equal."""
    keys = list(keys)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = transform(batch)
        own = first_per_key(rows, keys, list(order) if order else [c for c in rows.columns if c not in keys], descending=False)
        known = parts(spark, out_dir, own.schema, before=batch_id).select(*keys).alias("known")
        same = [own[k].eqNullSafe(known[k]) for k in keys]
        own.join(known, same, "left_anti").write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return _run(stream, each_batch, checkpoint, available_now)


def stream_dedup(spark: SparkSession, in_dir: str, schema: T.StructType, out_dir: str, checkpoint: str,
                 keys: Sequence[str], order: Sequence[str] | None = None, fmt: str = "parquet",
                 available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """One row per key of the files that land in ``in_dir``, into parts below ``out_dir`` (read with ``parts``)."""
    return stream_keep_one(_source(spark, in_dir, schema, fmt, max_files), lambda df: df, out_dir, checkpoint, keys, order, available_now)


def stream_release_load(spark: SparkSession, in_dir: str, transform: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str,
                        schema: T.StructType, available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """The weekly load as a stream: page JSON files through ``transform`` (pages -> typed rows), one row per ``uri``."""
    return stream_keep_one(_source(spark, in_dir, schema, "json", max_files), transform, out_dir, checkpoint, ["uri"], None, available_now)


def latest_version(spark: SparkSession, versions_dir: str, before: int | None = None) -> str | None:
    """Folder of the highest complete version (of those of batches smaller than ``before``)."""
    ids = [int(v) for v in complete(spark, versions_dir, "v")]
    ids = [v for v in ids if before is None or v < before]
    return f"{versions_dir}/v={max(ids)}" if ids else None


def stream_upsert(spark: SparkSession, in_dir: str, schema: T.StructType, versions_dir: str, checkpoint: str,
                  initial: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame],
                  fmt: str = "parquet", available_now: bool = True, max_files: int | None = None) -> str | StreamingQuery:
    """Upsert each micro-batch into a dimension; returns the folder of the latest version.

    ``initial`` is the dimension before the stream, written once as version -1;
    ``apply(dim, batch)`` returns the next version from the highest complete one of an earlier batch.
    """
    if latest_version(spark, versions_dir) is None:
        initial.write.mode("overwrite").parquet(f"{versions_dir}/v=-1")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        dim = batch.sparkSession.read.parquet(latest_version(spark, versions_dir, before=batch_id))
        apply(dim, batch).write.mode("overwrite").parquet(f"{versions_dir}/v={batch_id}")

    q = _run(_source(spark, in_dir, schema, fmt, max_files), each_batch, checkpoint, available_now)
    return latest_version(spark, versions_dir) if available_now else q
