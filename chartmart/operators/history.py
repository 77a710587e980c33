"""Slowly changing history (type 2 snapshot, timestamp strategy).

Each run compares the current source with the open rows of the previous snapshot:

* key new (no open row)                  -> insert, valid_from = updated_at
* key open and source updated_at is later -> close the open row at the new updated_at,
                                            insert the new version
* key open, updated_at not later         -> nothing (changes without a newer updated_at are ignored)
* key open but gone from the source      -> close at ``as_of`` when invalidating hard deletes
* closed rows                            -> unchanged

One full outer join of the open rows with the source on the key; closed rows bypass it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.operators.dims import ts_lit

SCD_COLS = ["scd_id", "scd_updated_at", "valid_from", "valid_to"]


def scd_id(key_cols: Sequence[str], updated_at: Column) -> Column:
    """md5 of the key parts and the version time, '|'-joined (a NULL part becomes '')."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    parts.append(F.coalesce(updated_at.cast("string"), F.lit("")))
    return F.md5(F.concat_ws("|", *parts))


def _first_version(current: DataFrame, key_cols: Sequence[str], updated_at: str) -> DataFrame:
    ts = F.col(updated_at).cast("timestamp_ntz")
    return current.select(*current.columns, scd_id(key_cols, ts).alias("scd_id"), ts.alias("scd_updated_at"),
                          ts.alias("valid_from"), ts_lit(None).alias("valid_to"))


def scd2_step(open_rows: DataFrame, current: DataFrame, key_cols: Sequence[str], updated_at: str,
              as_of: datetime | str, invalidate_hard_deletes: bool = True) -> tuple[DataFrame, DataFrame]:
    """One run over the *open* rows only: (rows this run closes, the next open rows).

    Closed history never takes part, so a run costs in proportion to the open rows, not to
    the whole history; callers append the first result to the history and replace the open set.
    """
    key_cols = list(key_cols)
    cols = current.columns
    cur = current.select(*[F.col(c).alias("_c_" + c) for c in cols], F.lit(True).alias("_c_present"))
    o = open_rows.withColumn("_o_present", F.lit(True))
    cond = None
    for k in key_cols:
        term = o[k] == cur["_c_" + k]
        cond = term if cond is None else cond & term
    j = o.join(cur, cond, "full_outer")

    o_here = F.coalesce(F.col("_o_present"), F.lit(False))
    c_here = F.coalesce(F.col("_c_present"), F.lit(False))
    c_ts = F.col("_c_" + updated_at).cast("timestamp_ntz")
    newer = o_here & c_here & F.coalesce(c_ts > F.col("scd_updated_at"), F.lit(False))
    if invalidate_hard_deletes:
        close_at = F.when(newer, c_ts).when(~c_here, ts_lit(as_of))
    else:
        close_at = F.when(newer, c_ts)
    out_cols = cols + SCD_COLS
    prev_rows = j.filter(o_here).select(*[F.col(c) for c in cols], "scd_id", "scd_updated_at", "valid_from",
                                         close_at.cast("timestamp_ntz").alias("valid_to"))
    fresh = j.filter(c_here & (~o_here | newer)).select(*[F.col("_c_" + c).alias(c) for c in cols])
    new_rows = _first_version(fresh, key_cols, updated_at).select(*out_cols)
    closed_now = prev_rows.filter(F.col("valid_to").isNotNull()).select(*out_cols)
    still_open = prev_rows.filter(F.col("valid_to").isNull()).select(*out_cols)
    return closed_now, still_open.unionByName(new_rows)


def check_unique_keys(current: DataFrame, key_cols: Sequence[str]) -> None:
    """A snapshot source holds one row per key; several would fan out the full outer join."""
    if not current.groupBy(*key_cols).count().filter(F.col("count") > 1).isEmpty():
        raise ValueError(f"snapshot source holds several rows for one key {list(key_cols)}")


def scd2_snapshot(prev: DataFrame | None, current: DataFrame, key_cols: Sequence[str], updated_at: str,
                  as_of: datetime | str, invalidate_hard_deletes: bool = True,
                  check_unique_source: bool = True) -> DataFrame:
    """Next snapshot table from the previous one (None on the first run) and the current source."""
    key_cols = list(key_cols)
    if check_unique_source:
        check_unique_keys(current, key_cols)
    if prev is None:
        return _first_version(current, key_cols, updated_at)
    out_cols = current.columns + SCD_COLS
    closed = prev.filter(F.col("valid_to").isNotNull()).select(*out_cols)
    closed_now, next_open = scd2_step(prev.filter(F.col("valid_to").isNull()), current, key_cols, updated_at,
                                      as_of, invalidate_hard_deletes)
    return closed.unionByName(closed_now).unionByName(next_open)
