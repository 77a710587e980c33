"""Marts over the fact: base view, weekly trend, artist streams and popularity.

Averages are raw doubles. ``ndigits`` rounds a mart's averages half-up from an exact decimal
sum, so that the result does not depend on summation order or engine: for comparisons only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.schemas import FACT_COLUMNS


def whole_sum(c: str) -> Column:
    """SUM of a bigint column as an exact decimal: the halves are summed as they are, and put together once a group."""
    high, low = F.sum(F.shiftright(c, 32)), F.sum(F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    return high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(20,0)")


def _avg(c: str, ndigits: int | None, whole: bool = False) -> Column:
    """AVG, rounded half-up to ``ndigits`` from an exact decimal sum: the result does not depend
    on summation order (partitioning), unlike a rounded double average near a tie.
    Of a bigint column (``whole``) the sum is ``whole_sum``."""
    if ndigits is None:
        return F.avg(c)
    if whole:
        total = whole_sum(c).cast("decimal(22,0)")
        return F.round(total / F.nullif(F.count(c), F.lit(0)).cast("decimal(15,0)"), ndigits).cast("double")
    return F.round(F.avg(F.col(c).cast("decimal(38,12)")), ndigits).cast("double")


def is_whole(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() == "long"


def base_fact(fact: DataFrame) -> DataFrame:
    """Explicit projection of the fact (an inlined view; Catalyst collapses it)."""
    return fact.select(*FACT_COLUMNS)


def weekly_trend(fact: DataFrame, ndigits: int | None = None, ordered: bool = False) -> DataFrame:
    """SUM(streams), AVG(rank) per date_key. Partial + final hash aggregation; sort only at a sink."""
    out = base_fact(fact).groupBy("date_key").agg(
        F.sum("streams").cast("bigint").alias("total_streams"),
        _avg("rank", ndigits, is_whole(fact, "rank")).alias("avg_rank"))
    return out.orderBy("date_key") if ordered else out


def artist_streams(fact: DataFrame, ndigits: int | None = None) -> DataFrame:
    return base_fact(fact).groupBy("artist_key").agg(
        F.sum("streams").cast("bigint").alias("total_streams"),
        _avg("rank", ndigits, is_whole(fact, "rank")).alias("avg_rank"),
        _avg("popularity_score", ndigits).alias("avg_popularity"))


def artist_popularity_by_key(fact: DataFrame, dim_artist: DataFrame, ndigits: int | None = None) -> DataFrame:
    """Aggregate first, then join the dimension; the not-NULL name filter turns the outer
    join into an inner one (Catalyst EliminateOuterJoin). Distinct over the result."""
    a = artist_streams(fact)
    da = dim_artist.select("artist_key", "artist_name")
    out = (a.join(da, "artist_key", "left").filter(F.col("artist_name").isNotNull())
           .select("artist_name", "total_streams", "avg_rank", "avg_popularity").distinct())
    if ndigits is None:
        return out
    return out.select("artist_name", "total_streams", *[F.round(F.col(c).cast("decimal(38,12)"), ndigits).cast("double").alias(c)
                                                        for c in ("avg_rank", "avg_popularity")]).distinct()


def artist_popularity_by_name(fact: DataFrame, dim_artist: DataFrame, ndigits: int | None = None) -> DataFrame:
    """Two-level aggregate: per-key sums and averages, then SUM / unweighted AVG per name;
    the NULL-name group (unmatched keys) is kept."""
    a = artist_streams(fact)
    da = dim_artist.select("artist_key", "artist_name")
    return (a.join(da, "artist_key", "left").groupBy("artist_name").agg(
        F.sum("total_streams").cast("bigint").alias("total_streams"),
        _avg("avg_rank", ndigits).alias("avg_rank"),
        _avg("avg_popularity", ndigits).alias("avg_popularity")))
