"""Dimensions of the star: artist, track, country, date, audio features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.functions import strip_prefix
from chartmart.operators.keys import assign_surrogate_keys

TS_TYPE = "timestamp_ntz"


def ts_lit(value: datetime | str | None) -> Column:
    """A run timestamp as a literal (passed in, never current_timestamp, for repeatable runs)."""
    if value is None:
        return F.lit(None).cast(TS_TYPE)
    return F.lit(str(value)).cast(TS_TYPE)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION (distinct): one distinct after the union; inner DISTINCTs would be redundant shuffles."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


ARTIST_NATURAL = ["artist_id", "artist_name", "artist_genre", "artist_img"]


def artist_rows(df: DataFrame) -> DataFrame:
    return df.select("artist_id", F.col("artist_individual").alias("artist_name"), "artist_genre", "artist_img")


def artist_filter(df: DataFrame) -> DataFrame:
    """id not NULL and genre <> '0'; three-valued logic also drops a NULL genre."""
    return df.filter(F.col("artist_id").isNotNull() & (F.col("artist_genre") != F.lit("0")))


def build_dim_artist(sources: Sequence[DataFrame], as_of: datetime | str) -> DataFrame:
    rows = union_distinct(*[artist_filter(artist_rows(s)) for s in sources])
    keyed = assign_surrogate_keys(rows, ARTIST_NATURAL, "artist_key")
    return keyed.select("artist_key", *ARTIST_NATURAL,
                        ts_lit(as_of).alias("effective_start_date"),
                        ts_lit(None).alias("effective_end_date"),
                        F.lit(True).alias("is_current"))


TRACK_NATURAL = ["uri", "track_name", "release_date", "album_cover", "album_num_tracks"]


def build_dim_track(sources: Sequence[DataFrame], as_of: datetime | str) -> DataFrame:
    rows = union_distinct(*[s.select(*TRACK_NATURAL) for s in sources])
    rows = rows.filter(F.col("release_date").isNotNull())  # Catalyst pushes this below the union
    keyed = assign_surrogate_keys(rows, TRACK_NATURAL, "track_key")
    return keyed.select("track_key", *TRACK_NATURAL, ts_lit(as_of).alias("effective_start_date"))


COUNTRY_NATURAL = ["country", "region", "language"]


def build_dim_country(chart: DataFrame) -> DataFrame:
    rows = chart.select(*COUNTRY_NATURAL).distinct()
    return assign_surrogate_keys(rows, COUNTRY_NATURAL, "country_key")


AUDIO_MEASURES = ["danceability", "energy", "tempo", "duration", "loudness", "valence", "acousticness",
                  "instrumentalness", "speechiness"]


def build_dim_audio(chart: DataFrame, extra_strip: int = 0) -> DataFrame:
    """Distinct uri + nine measures. ``extra_strip=15`` reproduces the second prefix strip
    applied to an already-stripped uri; the default strips once."""
    rows = chart.select("uri", *AUDIO_MEASURES).distinct()
    if extra_strip:
        rows = rows.withColumn("uri", strip_prefix("uri", extra_strip))
    return assign_surrogate_keys(rows, ["uri", *AUDIO_MEASURES], "audio_features_key")


# Day names for dayofweek 1..7 (1 = Sunday) and the weekend days.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
WEEKEND_DAYS = [1, 7]
DIM_DATE_START = "1990-01-01"
DIM_DATE_DAYS = 13149  # 1990-01-01 .. 2025-12-31


def build_dim_date(spark: SparkSession, start: str = DIM_DATE_START, days: int = DIM_DATE_DAYS) -> DataFrame:
    """Calendar from a row generator; key = day number + 1 (gap-free, no shuffle)."""
    d = F.col("d")
    dow = F.dayofweek(d)
    name = None
    for i, day in enumerate(DAY_NAMES, start=1):
        name = F.when(dow == i, F.lit(day)) if name is None else name.when(dow == i, F.lit(day))
    base = spark.range(days).select(
        (F.col("id") + 1).alias("date_key"),
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("d"))
    return base.select(
        F.col("date_key").cast("bigint").alias("date_key"),
        F.date_format(d, "yyyy-MM-dd").alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        name.alias("day_name"),
        dow.isin(*WEEKEND_DAYS).alias("is_weekend"),
    )
