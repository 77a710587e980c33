"""Dense surrogate keys (a warehouse SEQUENCE) without moving all rows into one task.

``row_number().over(Window.orderBy(...))`` has no partition key and gathers the whole
table into a single task. Instead:

1. range-partition by the order columns and sort within partitions,
2. tag each row with its partition id and its position inside the partition,
3. write the tagged rows once to shared storage (range bounds are sampled, so a
   recomputation could move rows; the written copy freezes them and survives executor loss),
4. count rows per partition (one tiny row per partition), sum the counts into running
   offsets, join them on the partition id, and add ``start + offset + position``.

The only data that meets in one place is the per-partition count table, whose size is
bounded by the number of partitions (not by the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartmart.session import scratch_path, stage

_POS_BITS = 33  # monotonically_increasing_id = partition id << 33 | position in partition


def _order_exprs(order_cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]


def assign_surrogate_keys(df: DataFrame, order_cols: Sequence[str | Column], key: str,
                          start: int | Column = 1, num_partitions: int | None = None,
                          tiebreak: bool = False) -> DataFrame:
    """Add ``key`` = start, start+1, ... following ``order_cols`` ascending, NULLs first.

    Order by enough columns to make the order total (for a distinct row set: all of them)
    so keys are deterministic; they then equal ``ROW_NUMBER() OVER (ORDER BY ... NULLS FIRST)``.
    ``start`` may be an int or a one-value column expression evaluated per row (e.g. a
    literal of the previous maximum + 1).

    Range partitioning cannot split *equal* order values, so for an input that is not
    distinct (one value may repeat for a third of the rows) pass ``tiebreak=True``: a
    seeded random last order column spreads equal rows over partitions. Equal rows are
    interchangeable, so the set of (key, row) pairs is the same.
    """
    spark = df.sparkSession
    order = _order_exprs(order_cols)
    if tiebreak:
        df_in = df
        df = df.withColumn("_tie", F.rand(17))
        order = order + [F.col("_tie").asc()]
    # without an explicit count AQE sizes the range partitions from the data (coalescing
    # neighbours keeps the order); an explicit count is honoured as given
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged
              .sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    path = scratch_path(spark, f"keys-{key}")
    tagged.write.mode("overwrite").parquet(path)
    frozen = spark.read.parquet(path)

    # one row per non-empty partition, with its running offset: joined on the partition id, so
    # the plan does not grow with the number of partitions
    counts = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stage(counts.select("_pid", F.coalesce(before, F.lit(0)).alias("_off")), f"offsets-{key}")

    start_col = start if isinstance(start, Column) else F.lit(int(start))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _POS_BITS)
    out_cols = df_in.columns if tiebreak else df.columns
    keyed = frozen.join(offsets, "_pid")  # as small as the number of partitions: the planner broadcasts it
    return keyed.select((start_col + F.col("_off") + pos).cast("bigint").alias(key), *out_cols)


def assign_from_sequence(df: DataFrame, order_cols: Sequence[str | Column], key: str, sequence) -> DataFrame:
    """``assign_surrogate_keys`` from a block that ``sequence`` (``sources.commits.Sequence``) gives out.

    No table is scanned for its largest key, and loaders that run at once get blocks of their own: keys are
    unique over all of them and dense within a load.
    """
    rows = stage(df, f"new-{key}")
    return assign_surrogate_keys(rows, order_cols, key, start=sequence.take(rows.count()))


def next_key(df: DataFrame, key: str) -> int:
    """First free key after a dimension's current maximum (one scalar from a global max)."""
    mx = df.agg(F.max(key).alias("m")).first()["m"]
    return 1 if mx is None else int(mx) + 1
