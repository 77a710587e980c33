"""Fixed schemas of the warehouse: raw landing tables, cleaned tables, dimensions, fact, marts.

Schemas are fixed, never inferred: files land as all-string rows and a second pass
try-casts them, so a bad value becomes NULL instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the chart file (35 columns, positional).
CHART_COLUMNS = [
    "uri", "rank", "artist_names", "artists_num", "artist_individual", "artist_id", "artist_genre",
    "artist_img", "collab", "track_name", "release_date", "album_num_tracks", "album_cover", "source",
    "peak_rank", "previous_rank", "weeks_on_chart", "streams", "week", "danceability", "energy", "key",
    "mode", "loudness", "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "duration", "country", "region", "language", "pivot",
]

# Column order of the release file (13 columns, positional).
RELEASE_COLUMNS = [
    "uri", "artist_names", "artists_num", "artist_individual", "artist_id", "artist_genre", "artist_img",
    "collab", "track_name", "release_date", "album_num_tracks", "album_cover", "region",
]


def all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_CHART = all_strings(CHART_COLUMNS)
RAW_RELEASE = all_strings(RELEASE_COLUMNS)

# Nested search page, only the fields the weekly load reads.
PAGE_ITEM = T.StructType([
    T.StructField("uri", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("album", T.StructType([
        T.StructField("release_date", T.StringType()),
        T.StructField("total_tracks", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("images", T.ArrayType(T.StructType([T.StructField("url", T.StringType())]))),
    ])),
    T.StructField("artists", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("id", T.StringType()),
    ]))),
])
PAGE = T.StructType([
    T.StructField("tracks", T.StructType([T.StructField("items", T.ArrayType(PAGE_ITEM))])),
])
ARTIST_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("images", T.ArrayType(T.StructType([T.StructField("url", T.StringType())]))),
])

TS = T.TimestampNTZType()

DIM_ARTIST = T.StructType([
    T.StructField("artist_key", T.LongType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("artist_genre", T.StringType()),
    T.StructField("artist_img", T.StringType()),
    T.StructField("effective_start_date", TS),
    T.StructField("effective_end_date", TS),
    T.StructField("is_current", T.BooleanType()),
])

DIM_TRACK = T.StructType([
    T.StructField("track_key", T.LongType()),
    T.StructField("uri", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("album_cover", T.StringType()),
    T.StructField("album_num_tracks", T.LongType()),
    T.StructField("effective_start_date", TS),
])

FACT_COLUMNS = [
    "track_key", "artist_key", "country_key", "date_key", "rank", "peak_rank", "previous_rank",
    "weeks_on_chart", "streams", "popularity_score",
]

CHECK_RESULT = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("should_warn", T.BooleanType()),
    T.StructField("should_error", T.BooleanType()),
])
