"""Release pages landed as VARIANT, for sources whose pages gain fields or break.

A page is kept as it came: fields that nobody asked for yet stay in it and can be read later
from the landed table. A text that is no page goes to a quarantine table with its reason
instead of ending the load or turning into a row of nulls. A field of another type than asked
for reads as NULL, in that field alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.functions import collab_flag, first_or_null, join_names

ITEMS = "$.tracks.items"


def scan_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """``raw``: one landed page for each line."""
    return spark.read.text(path).select(F.col("value").alias("raw"))


def _items(page: Column) -> Column:
    return F.try_variant_get(page, ITEMS, "array<variant>")


def parse_pages(texts: DataFrame) -> DataFrame:
    """``raw, page, reason`` of every text: a VARIANT, or why it is none (``empty``, ``not JSON``, ``no items``).

    Narrow and without a shuffle: write it once, then take ``landed`` and ``quarantined`` from it.
    """
    page = F.try_parse_json("raw")
    out = texts.select("raw", page.alias("page"))
    reason = (F.when(F.trim(F.coalesce("raw", F.lit(""))) == "", "empty").when(F.col("page").isNull(), "not JSON")
              .when(_items(F.col("page")).isNull(), "no items"))
    return out.withColumn("reason", reason)


def landed(parsed: DataFrame) -> DataFrame:
    """``page`` of the texts that are pages."""
    return parsed.where("reason is null").select("page")


def quarantined(parsed: DataFrame) -> DataFrame:
    """``raw, reason`` of all other texts, as they came."""
    return parsed.where("reason is not null").select("raw", "reason")


def flatten_variant_pages(pages: DataFrame, page_fields: Mapping[str, tuple[str, str]] | None = None,
                          item_fields: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """The rows of ``weekly.flatten_pages``, with further fields of the page or the item: name -> (path, type)."""
    more = [F.try_variant_get("page", path, kind).alias(name) for name, (path, kind) in (page_fields or {}).items()]
    items = pages.select(*more, F.explode(_items(F.col("page"))).alias("_t"))

    def get(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("_t", path, kind)

    items = items.select("*", get("$.artists", "array<struct<name:string,id:string>>").alias("_artists"),
                         get("$.album.images", "array<struct<url:string>>").alias("_images"))
    artists, first = F.col("_artists"), first_or_null(F.col("_artists"))
    return items.select(
        get("$.uri").alias("uri"), get("$.name").alias("track_name"), get("$.album.release_date").alias("release_date"),
        get("$.album.total_tracks", "bigint").alias("album_num_tracks"), first_or_null(F.col("_images"))["url"].alias("album_cover"),
        get("$.album.label").alias("source"), join_names(artists, "name").alias("artist_names"),
        F.size(artists).cast("bigint").alias("artists_num"), first["name"].alias("artist_individual"), first["id"].alias("artist_id"),
        collab_flag(F.size(artists)).alias("collab"), *(page_fields or {}),
        *[get(path, kind).alias(name) for name, (path, kind) in (item_fields or {}).items()])
