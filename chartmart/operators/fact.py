"""Fact build: star lookup of surrogate keys + measures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.functions import safe_ratio
from chartmart.operators.dedup import by_keys, if_small, suspects
from chartmart.schemas import FACT_COLUMNS


@dataclass(frozen=True)
class Lookup:
    """Resolve ``key`` of ``dim`` by equality of ``src_col`` with ``dim_col``.

    ``cast`` converts the dimension's column before the join (e.g. a STRING date to DATE).
    ``broadcast``: True only for dimensions of a fixed, proven size (the calendar); None
    leaves the choice to Catalyst's size estimate and AQE's runtime statistics.
    ``few``: a dimension of this many rows at most (they are counted: of a staged one by its footers) is
    broadcast, so that rows which the lookups before it fanned out are not shuffled.
    ``salt``: for a dimension too large to broadcast whose natural keys are hot in the
    source (one key may carry a third of the rows), spread each source key over ``salt``
    buckets by a hash of the row and replicate the dimension rows into every bucket, so a hot key is
    joined by ``salt`` tasks instead of one. The result is exactly the unsalted join.
    ``heavy``: likewise without replicating the whole dimension. Keys that hold this share of the
    source's rows or more (as a mergeable frequency sketch of the column estimates) are
    joined to their dimension rows by a broadcast of a checked size; the others shuffle, and
    the heavy rows pass that shuffle spread by a hash of the row. A wrong estimate costs time only.
    """

    dim: DataFrame
    src_col: str
    dim_col: str
    key: str
    cast: str | None = None
    broadcast: bool | None = None
    salt: int = 0
    heavy: float | None = None
    few: int = 0


FEW_ROWS = 1_000_000  # most rows (natural key, key) of a dimension that are broadcast
HEAVY_ROWS = 1_000_000  # most dimension rows that are broadcast for heavy keys
_TRACKED = 10_000  # keys that the sketch tracks
_SPREAD = 1 << 20


def heavy_keys(src: DataFrame, column: str, share: float) -> list:
    """Values of a column that hold about ``share`` of its rows or more; at most ``1 / share`` of them."""
    most = max(1, int(1 / share))
    found = src.where(F.col(column).isNotNull()).select(F.col(column).alias("_k")).agg(
        F.expr(f"approx_top_k(_k, {most}, {max(_TRACKED, most)})").alias("top"), F.count("_k").alias("n")).first()
    return sorted(x["item"] for x in found["top"] or [] if x["count"] >= share * found["n"])


def _heavy_lookup(out: DataFrame, d: DataFrame, lk: Lookup, alias: str) -> DataFrame:
    """``out`` LEFT JOIN ``d`` (``alias``, key), heavy keys apart."""
    from chartmart.session import stage

    heavy = heavy_keys(out, lk.src_col, lk.heavy)
    if not heavy:
        return out.join(d, out[lk.src_col] == d[alias], "left").drop(alias)
    values = [F.lit(v) for v in heavy]
    is_heavy = F.coalesce(F.col(lk.src_col).isin(values), F.lit(False))
    few = stage(d.where(F.col(alias).isin(values)).withColumnRenamed(alias, "_heavy").withColumnRenamed(lk.key, "_heavy_key"), "heavy")
    if few.count() <= HEAVY_ROWS:
        few = F.broadcast(few)
    # always 0, but nothing that the planner folds: a literal would turn the join key into a filter
    rest = d.where(~F.col(alias).isin(values)).withColumn("_side", F.xxhash64(alias).bitwiseAND(F.lit(0)))
    # the rows of heavy keys meet nothing on the other side, wherever they go
    spread = F.when(is_heavy, 1 + F.pmod(F.xxhash64(*out.columns), F.lit(_SPREAD))).otherwise(0).cast("bigint")
    names = out.columns
    out = out.withColumn("_spread", spread).join(few, F.col(lk.src_col) == F.col("_heavy"), "left")
    out = out.join(rest, (F.col(lk.src_col) == F.col(alias)) & (F.col("_spread") == F.col("_side")), "left")
    return out.select(*names, F.coalesce("_heavy_key", lk.key).alias(lk.key))


def star_lookup(src: DataFrame, lookups: Sequence[Lookup], lookup: str = "all") -> DataFrame:
    """LEFT JOIN each dimension on its natural key. Unmatched rows keep a NULL key.

    ``lookup="all"`` is literal: a natural key held by several dimension rows fans the
    source row out. ``lookup="first"`` takes the lowest key per natural key (a partial
    aggregation of the dimension, then a many-to-one join).
    """
    if lookup not in ("all", "first"):
        raise ValueError("lookup must be 'all' or 'first'")
    out = src
    for i, lk in enumerate(lookups):
        nat = F.col(lk.dim_col)
        if lk.cast:
            nat = nat.cast(lk.cast)
        alias = f"_lk{i}"
        d = lk.dim.select(nat.alias(alias), F.col(lk.key))
        if lookup == "first":
            d = d.groupBy(alias).agg(F.min(lk.key).alias(lk.key))
        if lk.broadcast:
            d = F.broadcast(d)
            out = out.join(d, out[lk.src_col] == d[alias], "left").drop(alias)
        elif lk.heavy:
            out = _heavy_lookup(out, d, lk, alias)
        elif lk.salt and lk.salt > 1:
            salt = f"_salt{i}"
            d = d.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(lk.salt - 1))))
            out = out.withColumn(salt, F.pmod(F.xxhash64(*out.columns), F.lit(lk.salt)).cast("int"))  # the same if a task is run again
            out = out.join(d, (out[lk.src_col] == d[alias]) & (out[salt] == d[salt]), "left").drop(alias, salt)
        else:
            d = if_small(d, lk.few) if lk.few else d
            out = out.join(d, out[lk.src_col] == d[alias], "left").drop(alias)
    return out


def build_fact(chart: DataFrame, dim_track: DataFrame, dim_artist: DataFrame, dim_country: DataFrame,
               dim_date: DataFrame, lookup: str = "all") -> DataFrame:
    src = chart.select("uri", "artist_id", "country", "week", "rank", "peak_rank", "previous_rank",
                       "weeks_on_chart", "streams")
    joined = star_lookup(src, [
        Lookup(dim_track, "uri", "uri", "track_key", few=FEW_ROWS),
        Lookup(dim_artist, "artist_id", "artist_id", "artist_key", few=FEW_ROWS),
        Lookup(dim_country, "country", "country", "country_key", few=FEW_ROWS),
        Lookup(dim_date, "week", "full_date", "date_key", cast="date", broadcast=True),
    ], lookup=lookup)
    return joined.select(
        "track_key", "artist_key", "country_key", "date_key", "rank", "peak_rank", "previous_rank",
        "weeks_on_chart", "streams", safe_ratio("streams", "rank").alias("popularity_score"),
    ).select(*FACT_COLUMNS)


FACT_KEYS = ["track_key", "artist_key", "country_key", "date_key"]


FACT_NATURAL = ["uri", "artist_id", "country", "week"]
FACT_MEASURES = ["rank", "peak_rank", "previous_rank", "weeks_on_chart", "streams"]


def purge_before_fanout(chart: DataFrame, dim_track: DataFrame, dim_artist: DataFrame, dim_country: DataFrame,
                        dim_date: DataFrame) -> DataFrame:
    """The fact's duplicate purge, applied to the chart rows *before* the lookups multiply them.

    A fact key identifies one dimension row, hence one natural key, so two fact rows with
    equal non-NULL keys come from chart rows with the same four natural keys, and every chart
    row with those natural keys yields the same key combinations. A fact row with a NULL key
    is never deleted. Hence: natural-key tuples that are present in all four dimensions and
    hold a group of chart rows equal on natural keys and measures (popularity is a function
    of streams and rank) are exactly the purged ones; their chart rows are dropped here.
    """
    from chartmart.session import stage

    # repeated rows first: their narrow hashes are all that is shuffled of the whole chart
    present = suspects(chart.select(*FACT_NATURAL, *FACT_MEASURES), [*FACT_NATURAL, *FACT_MEASURES])
    for dim, src_col, dim_col, cast in ((dim_track, "uri", "uri", None), (dim_artist, "artist_id", "artist_id", None),
                                        (dim_country, "country", "country", None),
                                        (dim_date, "week", "full_date", "date")):
        nat = F.col(dim_col).cast(cast) if cast else F.col(dim_col)
        keys = dim.select(nat.alias("_nat")).distinct()
        if dim is dim_date:
            keys = F.broadcast(keys)  # the calendar: fixed size
        present = present.join(keys, present[src_col] == keys["_nat"], "left_semi")
    groups = present.groupBy(*FACT_NATURAL, *FACT_MEASURES).agg(F.count(F.lit(1)).alias("_n"))
    dup = stage(groups.filter(F.col("_n") > 1).select(*FACT_NATURAL).distinct(), "fact_dup_natural")
    if dup.isEmpty():
        return chart
    return by_keys(chart, dup, FACT_NATURAL, "left_anti")
