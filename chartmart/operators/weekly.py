"""Weekly release load: nested search pages -> flat rows -> enrichment -> 7-day window -> clean.

The web-API paging itself is not rebuilt (a single-machine network client); pages are
landed as JSON files and Spark reads, explodes and flattens them in parallel.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.functions import collab_flag, first_or_null, infer_country, join_names, released_in_last_days
from chartmart.operators.dedup import first_per_key
from chartmart.schemas import ARTIST_RECORD, PAGE, RELEASE_COLUMNS

ITEM_COLUMNS = ["uri", "track_name", "release_date", "album_num_tracks", "album_cover", "source",
                "artist_names", "artists_num", "artist_individual", "artist_id", "collab"]


def scan_release_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search pages (one JSON object per page) with a fixed schema; missing fields read as NULL."""
    return spark.read.schema(PAGE).json(path)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per track item: names joined with ', ', first artist, first cover, collab flag."""
    items = pages.select(F.explode("tracks.items").alias("t"))
    t = F.col("t")
    return items.select(
        t["uri"].alias("uri"),
        t["name"].alias("track_name"),
        t["album"]["release_date"].alias("release_date"),
        t["album"]["total_tracks"].alias("album_num_tracks"),
        first_or_null(t["album"]["images"])["url"].alias("album_cover"),
        t["album"]["label"].alias("source"),
        join_names(t["artists"], "name").alias("artist_names"),
        F.size(t["artists"]).cast("bigint").alias("artists_num"),
        first_or_null(t["artists"])["name"].alias("artist_individual"),
        first_or_null(t["artists"])["id"].alias("artist_id"),
        collab_flag(F.size(t["artists"])).alias("collab"),
    )


def scan_artists(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARTIST_RECORD).json(path)


def artist_attributes(artists: DataFrame) -> DataFrame:
    """Genres joined with ', ' ('' for none) and the first image url (NULL for none)."""
    return artists.select(
        F.col("id").alias("_artist_id"),
        F.coalesce(F.array_join("genres", ", "), F.lit("")).alias("artist_genre"),
        first_or_null("images")["url"].alias("artist_img"),
    )


def enrich_artist(items: DataFrame, artists: DataFrame) -> DataFrame:
    """Per-item artist lookup as a LEFT join on the first artist's id, plus the inferred country.

    An artist that was landed several times counts once (records are compared as they are and
    the greatest is taken), so items never multiply."""
    a = first_per_key(artist_attributes(artists), ["_artist_id"], ["artist_genre", "artist_img"])
    j = items.join(a, items["artist_id"] == a["_artist_id"], "left").drop("_artist_id")
    return j.withColumn("country", infer_country("artist_genre"))


def weekly_rows(enriched: DataFrame, as_of: date | str, days: int = 7) -> DataFrame:
    """Tracks released on one of the ``days`` days before ``as_of``, in the weekly table's
    13-column shape (country and label are derived upstream, then dropped here)."""
    keep = enriched.filter(released_in_last_days("release_date", as_of, days))
    return keep.withColumn("region", F.lit("Global")).select(*RELEASE_COLUMNS)
