"""Streams that keep their memory in Spark's state store or in a stored dimension.

``stream_dedup_within``  one row per key by ``dropDuplicatesWithinWatermark``: a batch costs what
                         it brings, whatever was emitted before, and keys are forgotten when the
                         watermark has passed their event time by the delay. Rows that come too
                         late for the watermark are not lost: they are listed beside the result.
``stream_merge``         each micro-batch merged into a stored dimension by bucket, as one commit
                         named after the batch.

``release_stream`` has the forms that are exact whatever comes how late, at a cost that grows
with what was emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chartmart.sources.commits import CommittedTable
from chartmart.sources.versions import complete
from chartmart.streaming.release_stream import _run, _source, parts

_KEPT = "_kept"


def stream_dedup_within(spark: SparkSession, in_dir: str, schema: T.StructType, out_dir: str, checkpoint: str, keys: Sequence[str], event_time: str,
                        delay: str, fmt: str = "parquet", available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """One row per key of the files that land in ``in_dir``, as long as a key's rows lie within ``delay`` of each other.

    A batch's rows are late if their event time is not after the greatest one of the batches up
    to the last but one, less ``delay`` (the watermark that Spark compares them with; after the
    last data of a run Spark adds an empty batch, so the next run sees all of them). ``kept`` and ``late``
    read the two sides; rows without an event time are on the late side. A retried batch
    rewrites its own part of both.
    """
    stream = _source(spark, in_dir, schema, fmt, max_files)
    timely = stream.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    both = timely.withColumn(_KEPT, F.lit(True)).unionByName(stream.withColumn(_KEPT, F.lit(False)))

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        late = F.col(event_time).isNull()
        if (greatest := _greatest(own, out_dir, batch_id - 1)) is not None:
            late = late | (F.col(event_time) <= F.date_trunc("millisecond", F.lit(greatest)) - F.expr(f"INTERVAL {delay}"))
        seen = Observation()
        watched = batch.observe(seen, F.max(F.when(~F.col(_KEPT), F.col(event_time))).alias("greatest"))
        # one write: the state is updated by running the batch, so it runs once
        watched.where(F.col(_KEPT) | late).write.mode("overwrite").parquet(f"{out_dir}/rows/batch={batch_id}")
        try:
            greatest = seen.get["greatest"]
        except Exception:  # nothing is observed where the planner knows that there are no rows
            greatest = None
        mark = own.createDataFrame([(greatest,)], T.StructType([T.StructField("greatest", schema[event_time].dataType)]))
        mark.write.mode("overwrite").parquet(f"{out_dir}/marks/batch={batch_id}")

    return _run(both, each_batch, checkpoint, available_now)


def _greatest(spark: SparkSession, out_dir: str, before: int):
    """Greatest event time of the batches smaller than ``before``."""
    ids = [b for b in complete(spark, f"{out_dir}/marks", "batch") if int(b) < before]
    return spark.read.parquet(*[f"{out_dir}/marks/batch={b}" for b in ids]).agg(F.max("greatest")).first()[0] if ids else None


def _sides(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    return parts(spark, f"{out_dir}/rows", T.StructType([*schema.fields, T.StructField(_KEPT, T.BooleanType())]))


def kept(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """The rows that ``stream_dedup_within`` has emitted."""
    return _sides(spark, out_dir, schema).where(_KEPT).drop(_KEPT)


def late(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """The rows that came too late for it; their number is what Spark reports as dropped by watermark."""
    return _sides(spark, out_dir, schema).where(~F.col(_KEPT)).drop(_KEPT)


def stream_merge(spark: SparkSession, in_dir: str, schema: T.StructType, table: CommittedTable, checkpoint: str,
                 merge: Callable[[DataFrame, str], object], fmt: str = "parquet", available_now: bool = True,
                 max_files: int | None = None) -> StreamingQuery:
    """``merge(batch, run)`` for every micro-batch, with the run's label, into a stored dimension.

    ``merge`` commits under the label (``operators.bucketed.merge_into``); a batch that is run
    again after its commit is passed over. A table belongs to one checkpoint.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        run = f"batch {batch_id}"
        if table.committed(run) is None:
            merge(batch, run)

    return _run(_source(spark, in_dir, schema, fmt, max_files), each_batch, checkpoint, available_now)
