"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator of the
inventory, each reading the driver's whole tables (or data Spark derives from them)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmart.functions import safe_ratio, strip_prefix, try_date, try_float, try_int
from chartmart.operators.bucketed import PurgeIndex, merge_into, store_dimension
from chartmart.operators.clean import CHART_COMPARE, CHART_SPEC, RELEASE_SPEC, WEEKLY_SPEC, clean
from chartmart.operators.dedup import drop_exact_duplicates, flag_duplicates, latest_per_key
from chartmart.operators.dims import (ARTIST_NATURAL, COUNTRY_NATURAL, artist_filter, artist_rows, build_dim_artist, build_dim_audio, build_dim_country,
                                      build_dim_date, build_dim_track, ts_lit, union_distinct)
from chartmart.operators.fact import Lookup, build_fact, star_lookup
from chartmart.operators.history import scd2_snapshot
from chartmart.operators.incremental_marts import ARTIST, WEEKLY, IncrementalMart
from chartmart.operators.keys import assign_from_sequence, assign_surrogate_keys, next_key
from chartmart.operators.marts import (artist_popularity_by_key, artist_popularity_by_name, artist_streams, base_fact,
                                       weekly_trend)
from chartmart.operators.quality import (check_fanout, check_foreign_key, check_key, check_not_null, check_result,
                                         check_unique)
from chartmart.operators.upsert import artist_day, artist_merge, select_run_date, track_day, track_merge, upsert_dim_artist, upsert_dim_track
from chartmart.operators.stored_history import StoredHistory
from chartmart.operators.variant_pages import flatten_variant_pages, landed, parse_pages, quarantined, scan_page_texts
from chartmart.operators.weekly import (enrich_artist, flatten_pages, scan_artists, scan_release_pages, weekly_rows)
from chartmart.plans.flows import (HIST_AS_OF, MERGE_AS_OF, RELEASE_LOAD_TS, RUN_DATE, WEEKLY_AS_OF, clean_chart,
                                   clean_release, compiled_mart_checks, mart_checks, run_dimensions, run_fact, run_historical_chart,
                                   run_historical_release, run_incremental_dims, run_marts, run_snapshot,
                                   run_weekly_load, stage_release, weekly_typed)
from chartmart.plans.models import Model, run_models
from chartmart.schemas import PAGE, RAW_CHART
from chartmart.session import scratch_path, stage
from chartmart.sources import binding as B
from chartmart.sources.catalog import Catalog
from chartmart.sources.commits import CommittedTable, Conflict, Sequence
from chartmart.sources.files import FileFormat, ensure_table, scan_csv, write_append, write_counted, write_csv, write_replace
from chartmart.streaming.release_stream import parts, stream_dedup, stream_release_load, stream_upsert
from chartmart.streaming.stateful import kept, late, stream_dedup_within, stream_merge

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6  # averages are compared after rounding, here and in the SQL; the operators keep raw doubles
SNAPSHOT_AS_OF = ["2024-01-02 00:00:00", "2024-02-02 00:00:00", "2024-03-02 00:00:00"]


# ---------------------------------------------------------------- shared stages

def chart_clean(spark, sf) -> DataFrame:
    return clean(B.chart_raw(spark, sf), CHART_SPEC)


def chart_purged(spark, sf) -> DataFrame:
    """Cleaned, deduplicated chart rows: staged typed rows minus the (checked-size) duplicate keys."""
    return clean_chart(B.chart_raw(spark, sf))


def release_clean(spark, sf) -> DataFrame:
    return clean(B.release_raw(spark, sf), RELEASE_SPEC, load_timestamp=ts_lit(RELEASE_LOAD_TS))


def release_purged(spark, sf) -> DataFrame:
    return stage_release(clean_release(B.release_raw(spark, sf)))


def all_dims(spark, sf, chart=None, release=None) -> dict[str, DataFrame]:
    chart = chart if chart is not None else chart_purged(spark, sf)
    release = release if release is not None else release_purged(spark, sf)
    # independent jobs, submitted together
    return run_dimensions(spark, chart, release, HIST_AS_OF, which=("dim_artist", "dim_track", "dim_country", "dim_date"))


def fact_and_dims(spark, sf) -> tuple[DataFrame, dict[str, DataFrame]]:
    chart = chart_purged(spark, sf)
    dims = all_dims(spark, sf, chart)
    # the fact is a lazy plan here (broadcast lookups over staged rows): each query reads it once
    return run_fact(chart, dims), dims


def staged_fact_and_dims(spark, sf) -> tuple[DataFrame, dict[str, DataFrame]]:
    """For queries that read the fact more than once: its lookups run once."""
    fact, dims = fact_and_dims(spark, sf)
    return stage(fact, "fact"), dims


def landed_chart_csv(spark, sf) -> str:
    path = scratch_path(spark, "chart_csv")
    write_csv(B.chart_raw(spark, sf), path)
    return path


def landed_pages(spark, sf) -> tuple[DataFrame, DataFrame]:
    pages_path = scratch_path(spark, "pages_json")
    B.pages(spark, sf).write.mode("overwrite").json(pages_path)
    artists_path = scratch_path(spark, "artists_json")
    B.artist_records(spark, sf).write.mode("overwrite").json(artists_path)
    return scan_release_pages(spark, pages_path), scan_artists(spark, artists_path)


def weekly_items(spark, sf) -> DataFrame:
    pages, _ = landed_pages(spark, sf)
    return flatten_pages(pages)


def weekly_enriched(spark, sf) -> DataFrame:
    pages, artists = landed_pages(spark, sf)
    return enrich_artist(flatten_pages(pages), artists)


def snapshot_runs(spark, sf, n_runs: int) -> DataFrame:
    """Run the history snapshot over successive loads of the customer source."""
    first, second = B.customer_versions(spark, sf)
    if n_runs == 2:
        loads = [first, second]
    else:
        c = B.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                       "c_mktsegment")
        full = c.withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        loads = [full, full.filter(F.col("c_custkey") % 11 != 0), full]
    snap = None
    for i, load in enumerate(loads):
        snap = stage(scd2_snapshot(snap, load, ["c_custkey"], "updated_at", SNAPSHOT_AS_OF[i]), f"snapshot_{i}")
    return snap


# ---------------------------------------------------------------- queries

def q_land_as_strings(spark, sf):
    return scan_csv(spark, landed_chart_csv(spark, sf), RAW_CHART)


DOC_STRINGS = T.StructType([T.StructField(c, T.StringType()) for c in ("doc_id", "text", "lang", "source", "n_chars")])


def q_scan_csv_format(spark, sf):
    docs = B.read_table(spark, sf, "documents").select(*[F.col(c).cast("string").alias(c) for c in DOC_STRINGS.names])
    path = scratch_path(spark, "documents_csv")
    write_csv(docs, path)
    return scan_csv(spark, path, DOC_STRINGS, FileFormat(multi_line=True))  # texts hold newlines


def q_strip_prefix(spark, sf):
    r = B.chart_raw(spark, sf)
    return r.select(F.col("uri").alias("raw_uri"), strip_prefix("uri").alias("uri"),
                    F.col("artist_id").alias("raw_artist_id"), strip_prefix("artist_id").alias("artist_id"),
                    strip_prefix("uri", sep=":").alias("track_id"))


def q_try_cast_int(spark, sf):
    r = B.chart_raw(spark, sf)
    return r.select(F.col("streams").alias("raw_streams"), try_int("streams").alias("streams"),
                    F.col("rank").alias("raw_rank"), try_int("rank").alias("rank"))


def q_try_cast_float(spark, sf):
    r = B.chart_raw(spark, sf)
    return r.select(*[x for c in ("danceability", "tempo", "loudness")
                      for x in (F.col(c).alias("raw_" + c), try_float(c).alias(c))])


def q_try_parse_date(spark, sf):
    c = B.chart_raw(spark, sf).select(F.lit("chart").alias("src"), F.col("week").alias("raw_value"))
    r = B.release_raw(spark, sf).select(F.lit("release").alias("src"), F.col("release_date").alias("raw_value"))
    both = c.unionByName(r)
    return both.select("src", "raw_value", try_date("raw_value").alias("value"))


def q_safe_ratio(spark, sf):
    c = chart_clean(spark, sf)
    return c.select("streams", "rank", safe_ratio("streams", "rank").alias("popularity_score"))


def q_filter_null_semantics(spark, sf):
    c = chart_clean(spark, sf)
    return (artist_filter(c).groupBy("artist_id", "artist_genre").agg(F.count(F.lit(1)).alias("n_rows")))


def q_flag_duplicates(spark, sf):
    return flag_duplicates(chart_clean(spark, sf), CHART_COMPARE, ["uri"])


def q_drop_exact_duplicates(spark, sf):
    docs = B.read_table(spark, sf, "documents")
    return drop_exact_duplicates(docs, ["text"], order=["doc_id"])


def q_latest_per_key(spark, sf):
    ev = B.read_table(spark, sf, "events")
    return latest_per_key(ev, ["user_id"], ["ts", "event_id"])


def q_union_distinct(spark, sf):
    return union_distinct(artist_filter(artist_rows(chart_purged(spark, sf))),
                          artist_filter(artist_rows(release_purged(spark, sf))))


def q_surrogate_key(spark, sf):
    part = B.read_table(spark, sf, "part").select("p_name", "p_brand", "p_type").distinct()
    return assign_surrogate_keys(part, ["p_name", "p_brand", "p_type"], "part_key")


def q_dim_artist(spark, sf):
    return build_dim_artist([chart_purged(spark, sf), release_purged(spark, sf)], HIST_AS_OF)


def q_dim_track(spark, sf):
    return build_dim_track([chart_purged(spark, sf), release_purged(spark, sf)], HIST_AS_OF)


def q_dim_country(spark, sf):
    return build_dim_country(chart_purged(spark, sf))


def q_dim_date(spark, sf):
    return build_dim_date(spark)


def q_dim_audio(spark, sf):
    return build_dim_audio(chart_purged(spark, sf))


def q_dim_audio_double_strip(spark, sf):
    """The literal audio dimension: a second 15-character strip of the already stripped uri."""
    return build_dim_audio(chart_purged(spark, sf), extra_strip=15)


def q_keep_one_chart(spark, sf):
    """Chart cleanup with keep-one instead of purge: one row per repeated group, lowest rank."""
    return clean_chart(B.chart_raw(spark, sf), dedup_how="keep_one")


def q_fact_date_lookup(spark, sf):
    c = chart_clean(spark, sf).select("uri", "week")
    d = build_dim_date(spark)
    j = star_lookup(c, [Lookup(d, "week", "full_date", "date_key", cast="date", broadcast=True)])
    return j.join(F.broadcast(d.select("date_key", "day_name")), "date_key", "left").select(
        "uri", "week", "date_key", "day_name")


def q_chart_calendar(spark, sf):
    """Every cleaned chart row with all attributes of its week in the calendar (13,149 rows, broadcast)."""
    c = chart_clean(spark, sf).select("uri", F.col("week").alias("chart_week"))
    d = build_dim_date(spark)
    j = star_lookup(c, [Lookup(d, "chart_week", "full_date", "date_key", cast="date", broadcast=True)])
    return j.select("uri", "chart_week", "date_key").join(F.broadcast(d), "date_key", "left")


def q_weekend_releases(spark, sf):
    """Releases a year and quarter that came out on the weekend days of the calendar."""
    r = release_clean(spark, sf).groupBy("release_date").agg(F.count("*").alias("n"))
    d = build_dim_date(spark).filter("is_weekend")
    j = r.join(F.broadcast(d.withColumn("release_date", F.to_date("full_date"))), "release_date")
    return j.groupBy("year", "quarter", "month_name", "day_name").agg(F.sum("n").cast("long").alias("n_releases"), F.min("full_date").alias("first_date"))


def q_fact_star_join(spark, sf):
    chart = chart_purged(spark, sf)
    d = all_dims(spark, sf, chart)
    return build_fact(chart, d["dim_track"], d["dim_artist"], d["dim_country"], d["dim_date"], "all")


def q_fact_star_join_first(spark, sf):
    chart = chart_purged(spark, sf)
    d = all_dims(spark, sf, chart)
    return build_fact(chart, d["dim_track"], d["dim_artist"], d["dim_country"], d["dim_date"], "first")


def q_fact_build(spark, sf):
    return fact_and_dims(spark, sf)[0]


def q_purge_tuple_key(spark, sf):
    """The literal purge of the fact on its four keys, after the lookups (``fact_build`` purges before them)."""
    chart = chart_purged(spark, sf)
    return run_fact(chart, all_dims(spark, sf, chart), purge_early=False)


def q_base_fact(spark, sf):
    return base_fact(fact_and_dims(spark, sf)[0])


def q_weekly_trend(spark, sf):
    return weekly_trend(fact_and_dims(spark, sf)[0], DIGITS)


def q_artist_streams(spark, sf):
    return artist_streams(fact_and_dims(spark, sf)[0], DIGITS)


def q_artist_popularity_by_key(spark, sf):
    fact, dims = fact_and_dims(spark, sf)
    return artist_popularity_by_key(fact, dims["dim_artist"], DIGITS)


def q_artist_popularity_by_name(spark, sf):
    fact, dims = fact_and_dims(spark, sf)
    return artist_popularity_by_name(fact, dims["dim_artist"], DIGITS)


def q_incremental_slice(spark, sf):
    return select_run_date(release_purged(spark, sf), "release_date", RUN_DATE)


def hist_dim_artist(spark, sf, chart=None):
    """Artist dimension of the chart history alone: the target of the daily release upsert."""
    return build_dim_artist([chart if chart is not None else chart_purged(spark, sf)], HIST_AS_OF)


def hist_dim_track(spark, sf, chart=None):
    return build_dim_track([chart if chart is not None else chart_purged(spark, sf)], HIST_AS_OF)


def q_merge_upsert_artist(spark, sf):
    dim_artist = hist_dim_artist(spark, sf)
    return upsert_dim_artist(dim_artist, release_purged(spark, sf), RUN_DATE, MERGE_AS_OF, on_stale="skip")


def q_merge_upsert_artist_stale_insert(spark, sf):
    dim_artist = hist_dim_artist(spark, sf)
    stale = dim_artist.withColumn("effective_start_date", ts_lit("2030-01-01 00:00:00"))
    return upsert_dim_artist(stale, release_purged(spark, sf), RUN_DATE, MERGE_AS_OF, on_stale="insert")


def q_merge_upsert_track(spark, sf):
    dim_track = hist_dim_track(spark, sf)
    return upsert_dim_track(dim_track, release_purged(spark, sf), RUN_DATE, MERGE_AS_OF, on_stale="skip")


def q_scd2_snapshot(spark, sf):
    return snapshot_runs(spark, sf, 2)


def q_scd2_hard_delete(spark, sf):
    return snapshot_runs(spark, sf, 3)


def q_dq_not_null(spark, sf):
    fact, _ = fact_and_dims(spark, sf)
    return check_result(check_not_null(fact, "artist_key"), "not_null_fact_artist_key")


def q_dq_unique(spark, sf):
    """Names of several artist rows (an artist with two genres has two)."""
    return check_unique(q_dim_artist(spark, sf), "artist_name")


def q_dq_report(spark, sf):
    fact, dims = staged_fact_and_dims(spark, sf)
    weekly = stage(weekly_trend(fact), "weekly_trend")
    by_name = stage(artist_popularity_by_name(fact, dims["dim_artist"]), "artist_popularity_by_name")
    return mart_checks(weekly, by_name)


def q_dq_primary_key(spark, sf):
    """The declared key of the cleaned chart, before its duplicates are purged."""
    return check_key(chart_clean(spark, sf), ["uri", "artist_id"])


def q_dq_foreign_key(spark, sf):
    """Documents without a label."""
    docs = B.read_table(spark, sf, "documents").select("doc_id", "lang", "source")
    return check_foreign_key(docs, B.read_table(spark, sf, "labels"), "doc_id")


def q_dq_fact_foreign_keys(spark, sf):
    """The fact's four declared foreign keys: orphans, and rows whose key is NULL (which is allowed)."""
    fact, dims = fact_and_dims(spark, sf)
    fact = stage(fact.select(*_oracle_dims()), "fact_keys")
    out = None
    for key, dim in _oracle_dims().items():
        rows_of = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))  # a key is looked up once, not once a row
        orphans = check_foreign_key(rows_of, dims[dim], key).agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("failures"))
        none = fact.agg(F.count(F.when(F.col(key).isNull(), 1)).alias("without_key"))
        row = orphans.crossJoin(none).select(F.lit(f"fk_{key}").alias("check_name"), "failures", "without_key")  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def _oracle_dims() -> dict[str, str]:
    return {"track_key": "dim_track", "artist_key": "dim_artist", "country_key": "dim_country", "date_key": "dim_date"}


def _tall(dims: dict[str, DataFrame]) -> DataFrame:
    """(dim, key, value): the text columns of each dimension in one string, so that all fit one table."""
    out = None
    for name, df in dims.items():
        key, names = DIM_COLUMNS[name]
        rows = df.select(F.lit(name).alias("dim"), F.col(key).alias("key"), F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("~")) for c in names]).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


DIM_COLUMNS = {"dim_artist": ("artist_key", ARTIST_NATURAL), "dim_track": ("track_key", ["uri", "track_name", "album_cover"]),
               "dim_country": ("country_key", COUNTRY_NATURAL), "dim_date": ("date_key", ["full_date", "day_name"]),
               "dim_audio_features": ("audio_features_key", ["uri"])}


def q_run_dimensions(spark, sf):
    """M3: the five dimensions of one run."""
    return _tall(run_dimensions(spark, chart_purged(spark, sf), release_purged(spark, sf), HIST_AS_OF))


def q_run_incremental_dims(spark, sf):
    """M4: the daily upserts of both dimensions as one run."""
    chart = chart_purged(spark, sf)  # typed and purged once for both
    dims = {"dim_artist": hist_dim_artist(spark, sf, chart), "dim_track": hist_dim_track(spark, sf, chart)}
    return _tall(run_incremental_dims(dims, release_purged(spark, sf), RUN_DATE, MERGE_AS_OF))


def q_run_marts(spark, sf):
    """M6: both marts of one run (their checks run too)."""
    fact, dims = staged_fact_and_dims(spark, sf)
    out = run_marts(fact, dims["dim_artist"], ndigits=DIGITS)
    weekly = out["weekly_trend"].select(F.lit("weekly_trend").alias("mart"), F.col("date_key").cast("string").alias("name"), "total_streams", "avg_rank")
    return weekly.unionByName(out["artist_popularity_by_name"].select(F.lit("artist_popularity_by_name").alias("mart"), F.col("artist_name").alias("name"),
                                                                      "total_streams", "avg_rank"))


def q_merge_upsert_track_stale_insert(spark, sf):
    """The literal MERGE on a target whose starts are stale, NULL and fresh by turns."""
    third = F.col("track_key") % 3
    mixed = hist_dim_track(spark, sf).withColumn("effective_start_date", F.when(third == 0, ts_lit("2030-01-01 00:00:00")).when(
        third == 1, ts_lit(None)).otherwise(F.col("effective_start_date")))
    return upsert_dim_track(mixed, release_purged(spark, sf), RUN_DATE, MERGE_AS_OF, on_stale="insert")


def q_run_snapshot(spark, sf):
    """Three runs of the stored snapshot on a composite key."""
    first, second = B.customer_versions(spark, sf)
    full = B.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").withColumn(
        "updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    cat = Catalog(spark, scratch_path(spark, "snapshot_catalog"))
    for load, as_of in zip([first, second, full], SNAPSHOT_AS_OF):
        out = run_snapshot(cat, "analytics.customer_snapshot", load, ["c_custkey", "c_nationkey"], "updated_at", as_of)
    return out


def q_snapshot_colocated(spark, sf):
    """The same three runs with open rows stored by key, and the closed files put together."""
    first, second = B.customer_versions(spark, sf)
    full = B.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").withColumn(
        "updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    history = StoredHistory(spark, scratch_path(spark, "history"), ["c_custkey", "c_nationkey"], "updated_at", buckets=8)
    for load, as_of in zip([first, second, full], SNAPSHOT_AS_OF):
        history.run(load, as_of)
    history.compact()
    return history.snapshot()


def parsed_pages(spark, sf) -> DataFrame:
    """Landed page texts of which some are broken, some have further fields and some a field of another type."""
    path = scratch_path(spark, "page_texts")
    B.page_texts(spark, sf).write.text(path)
    return stage(parse_pages(scan_page_texts(spark, path)), "parsed_pages")


def q_variant_items(spark, sf):
    return flatten_variant_pages(landed(parsed_pages(spark, sf)), {"page_id": ("$.page", "bigint"), "market": ("$.market", "string")})


def q_variant_quarantine(spark, sf):
    return quarantined(parsed_pages(spark, sf)).select(
        F.regexp_extract("raw", r'"page":(-?\d+)', 1).cast("bigint").alias("page_id"), "reason")


def q_write_tables(spark, sf):
    """Replace, counted write, append (columns in another order) and read back by name."""
    orders = B.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cat = Catalog(spark, scratch_path(spark, "write_catalog"))
    at = cat.location("raw.orders")
    write_replace(orders, at)
    written = write_counted(orders.where("o_orderstatus <> 'F'"), at)
    write_append(orders.where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey", "o_custkey"), at)
    return cat.table("raw.orders").withColumn("written", F.lit(written).cast("bigint"))


def q_dq_fanout(spark, sf):
    return check_fanout(q_dim_artist(spark, sf), ["artist_id"])


def q_flatten_release_pages(spark, sf):
    return weekly_items(spark, sf)


def q_array_flatten_names(spark, sf):
    return weekly_items(spark, sf).select("uri", "artist_names", "artists_num", "artist_individual", "artist_id")


def q_collab_flag(spark, sf):
    return weekly_items(spark, sf).select("uri", "artists_num", "collab")


def q_enrich_artist(spark, sf):
    return weekly_enriched(spark, sf).select("uri", "artist_id", "artist_genre", "artist_img")


def q_infer_country(spark, sf):
    return weekly_enriched(spark, sf).select("uri", "artist_genre", "country")


def q_rolling_week_filter(spark, sf):
    return weekly_rows(weekly_enriched(spark, sf), WEEKLY_AS_OF)


def q_clean_weekly(spark, sf):
    return clean(weekly_rows(weekly_enriched(spark, sf), WEEKLY_AS_OF), WEEKLY_SPEC)


def q_run_weekly_load(spark, sf):
    pages, artists = landed_pages(spark, sf)
    return run_weekly_load(pages, artists, WEEKLY_AS_OF)


def q_run_chart_clean(spark, sf):
    return run_historical_chart(spark, landed_chart_csv(spark, sf))


def q_run_release_clean(spark, sf):
    path = scratch_path(spark, "release_csv")
    write_csv(B.release_raw(spark, sf), path)
    return run_historical_release(spark, path, RELEASE_LOAD_TS)


def q_run_fact(spark, sf):
    chart = run_historical_chart(spark, landed_chart_csv(spark, sf))
    dims = all_dims(spark, sf, chart)
    return run_fact(chart, dims)


def feed(df: DataFrame, fmt: str, by, run: Callable[[str], object]) -> object:
    """``df`` landed in three turns, each by parallel writes into many files; after each turn the stream starts
    again from its checkpoint and takes the new files as one batch."""
    path = scratch_path(df.sparkSession, "landed")
    out = None
    for k in range(3):
        df.where(by == k).write.mode("append").format(fmt).save(path)
        out = run(path)
    return out


def q_stream_dedup(spark, sf):
    """Three batches in which keys return late, and the whole first batch landed again."""
    ev = B.read_table(spark, sf, "events")
    turn = F.pmod(F.hash("event_id"), F.lit(3))
    both = ev.withColumn("_turn", turn).unionByName(ev.where(turn == 0).withColumn("_turn", F.lit(2)))
    out_dir, ck = scratch_path(spark, "events_out"), scratch_path(spark, "events_ck")
    feed(both, "parquet", F.col("_turn"), lambda in_dir: stream_dedup(spark, in_dir, ev.schema, out_dir, ck, ["user_id", "event_type"]))
    return parts(spark, out_dir, ev.schema).select("user_id", "event_type")


def q_stream_release_load(spark, sf):
    """Page JSON in three batches; a track found by two searches comes again in another batch."""
    pages = B.pages(spark, sf)
    artists_path = scratch_path(spark, "artists_json")
    B.artist_records(spark, sf).write.mode("overwrite").json(artists_path)
    artists = scan_artists(spark, artists_path)
    out_dir, ck = scratch_path(spark, "weekly_out"), scratch_path(spark, "weekly_ck")
    load = lambda batch: weekly_typed(batch, artists, WEEKLY_AS_OF)
    feed(pages, "json", F.pmod(F.hash(F.to_json("tracks")), F.lit(3)), lambda in_dir: stream_release_load(spark, in_dir, load, out_dir, ck, PAGE))
    return parts(spark, out_dir, load(spark.createDataFrame([], PAGE)).schema)


def _by_day(release: DataFrame):
    """Turns of a feed: days before the run date, the run date, days after it."""
    day = F.datediff("release_date", F.lit(RUN_DATE).cast("date"))
    return F.when(day < 0, 0).when(day == 0, 1).otherwise(2)


def q_stream_upsert(spark, sf):
    """The run date's releases in one batch, then files of other days, which change nothing."""
    dim_artist = hist_dim_artist(spark, sf)
    rel = release_purged(spark, sf)
    versions, ck = scratch_path(spark, "dim_artist_versions"), scratch_path(spark, "dim_artist_ck")
    apply = lambda dim, batch: upsert_dim_artist(dim, batch, RUN_DATE, MERGE_AS_OF, "skip")
    latest = feed(rel, "parquet", _by_day(rel), lambda in_dir: stream_upsert(spark, in_dir, rel.schema, versions, ck, dim_artist, apply))
    return spark.read.parquet(latest)


def _stored(spark, dim: DataFrame, keys: list[str], key: str) -> tuple[CommittedTable, Sequence]:
    """A dimension laid out by ``keys``, and the sequence that goes on after its keys."""
    cat = Catalog(spark, scratch_path(spark, "merge_catalog"))
    table = cat.committed("raw.dimension")
    store_dimension(table, dim, keys)
    return table, Sequence(spark, cat.location("raw.keys"), start=next_key(dim, key))


def q_merge_bucketed_artist(spark, sf):
    """The daily artist MERGE into a stored dimension: only the buckets of the run date's artists are written anew."""
    table, keys = _stored(spark, hist_dim_artist(spark, sf), ["artist_id", "artist_genre"], "artist_key")
    merge_into(table, artist_day(release_purged(spark, sf), RUN_DATE), sequence=keys, run=RUN_DATE, **artist_merge(MERGE_AS_OF))
    return table.read()


def q_merge_bucketed_track(spark, sf):
    """The daily track MERGE likewise; its second run under the same label changes nothing."""
    table, keys = _stored(spark, hist_dim_track(spark, sf), ["uri", "track_name"], "track_key")
    day = track_day(release_purged(spark, sf), RUN_DATE)
    for _ in range(2):
        merge_into(table, day, sequence=keys, run=RUN_DATE, **track_merge(MERGE_AS_OF))
    return table.read()


def q_stream_merge(spark, sf):
    """The MERGE of a stream of releases into a stored dimension, in three turns."""
    table, keys = _stored(spark, hist_dim_artist(spark, sf), ["artist_id", "artist_genre"], "artist_key")
    rel, ck = release_purged(spark, sf), scratch_path(spark, "merge_ck")

    def merge(batch: DataFrame, run: str) -> None:
        merge_into(table, artist_day(batch, RUN_DATE), sequence=keys, run=run, **artist_merge(MERGE_AS_OF))

    feed(rel, "parquet", _by_day(rel), lambda in_dir: stream_merge(spark, in_dir, rel.schema, table, ck, merge))
    return table.read()


def q_reload_failed(spark, sf):
    """A reload that dies half way, an append, a wrong reload and its rollback: readers see whole versions only."""
    orders = B.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    table = Catalog(spark, scratch_path(spark, "reload_catalog")).committed("raw.orders")
    table.replace(orders.where("o_orderstatus <> 'F'"))
    unreadable = F.raise_error(F.lit("unreadable row")).cast("string")
    dying = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 1009 == 5, unreadable).otherwise(F.lit("new")))
    failed = 0
    try:
        table.replace(dying)
    except Exception as e:  # the job's own error; the rows read below show what it left
        failed = int("unreadable row" in str(e))
    good = table.append(orders.where("o_orderstatus = 'F'"))
    table.replace(orders.withColumn("o_orderstatus", F.lit("wrong")))
    version = table.rollback(good.number)
    return table.read().withColumn("failed", F.lit(failed)).withColumn("version", F.lit(version.number)).withColumn("of_two", F.lit(table.at(1).rows + good.rows).cast("bigint"))


def q_reload_conflict(spark, sf):
    """Two reloads that start from one version: the second to finish is refused, and then adds its rows instead."""
    orders = B.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cat = Catalog(spark, scratch_path(spark, "conflict_catalog"))
    one, two = cat.committed("raw.orders"), cat.committed("raw.orders")
    base = one.replace(orders)
    one.replace(orders.where("o_orderstatus = 'O'"), base=base)
    conflicts = 0
    try:
        two.replace(orders.where("o_orderstatus = 'P'"), base=base)
    except Conflict:
        conflicts += 1
        two.append(orders.where("o_orderstatus = 'P'"))
    return cat.table("raw.orders").withColumn("conflicts", F.lit(conflicts))


def q_sequence_keys(spark, sf):
    """Three loads of parts by two loaders that share a sequence: blocks follow each other, no table is scanned for its largest key."""
    part = B.read_table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    at = scratch_path(spark, "part_keys")
    loaders = [Sequence(spark, at), Sequence(spark, at)]
    out = None
    for k, low in enumerate((0, 20, 40)):
        rows = part.where((F.col("p_size") > low) & ((F.col("p_size") <= low + 20) if k < 2 else F.lit(True)))
        keyed = assign_from_sequence(rows, ["p_partkey"], "part_key", loaders[k % 2]).withColumn("load", F.lit(k))
        out = keyed if out is None else out.unionByName(keyed)
    return out


def q_purge_appended_loads(spark, sf):
    """Chart rows in three loads, each compared with the fingerprints of all earlier ones: as one purge of their union."""
    typed = chart_clean(spark, sf)
    turn = F.pmod(F.xxhash64(*typed.columns), F.lit(3))
    loads = stage(typed.withColumn("_turn", turn), "chart_clean", ["_turn"], "zstd")  # a folder for each load
    index = PurgeIndex(Catalog(spark, scratch_path(spark, "purge_catalog")).committed("raw.chart"), ["uri"], CHART_COMPARE)
    for k in range(3):  # copies that differ in rank alone come in different loads
        index.load(loads.where(F.col("_turn") == k).drop("_turn"), run=f"load {k}", stored=True)
    return index.rows()


def q_stream_dedup_state(spark, sf):
    """Keys remembered in the state store, by a delay that covers all event times: no row is late."""
    ev = B.read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out_dir, ck = scratch_path(spark, "state_out"), scratch_path(spark, "state_ck")
    feed(ev, "parquet", F.pmod(F.hash("event_id"), F.lit(3)), lambda in_dir: stream_dedup_within(
        spark, in_dir, ev.schema, out_dir, ck, ["user_id", "event_type"], "ts", "365 days"))
    n = late(spark, out_dir, ev.schema).agg(F.count(F.lit(1)).alias("n_late"))
    return kept(spark, out_dir, ev.schema).select("user_id", "event_type").crossJoin(n)  # one row


def q_stream_late_rows(spark, sf):
    """Every tenth event comes last: those more than a day behind are listed as late, the others are kept."""
    ev = B.read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    turn = F.when(F.col("event_id") % 10 == 0, 2).when(F.dayofmonth("ts") < 15, 0).otherwise(1)
    out_dir, ck = scratch_path(spark, "late_out"), scratch_path(spark, "late_ck")
    feed(ev, "parquet", turn, lambda in_dir: stream_dedup_within(spark, in_dir, ev.schema, out_dir, ck, ["event_id"], "ts", "1 day"))
    both = [side(spark, out_dir, ev.schema).select("event_id", "user_id").withColumn("late", F.lit(side is late)) for side in (kept, late)]
    return both[0].unionByName(both[1])


def q_fact_skew_lookup(spark, sf):
    """A third of the chart's rows under one track: its dimension row is broadcast, the other tracks shuffle."""
    chart = chart_purged(spark, sf)
    tracks = build_dim_track([chart, release_purged(spark, sf)], HIST_AS_OF)
    hot = tracks.agg(F.min("uri")).first()[0]
    skewed = chart.select(F.when(F.col("rank") % 3 == 0, F.lit(hot)).otherwise(F.col("uri")).alias("uri"), "rank", "streams")
    return star_lookup(skewed, [Lookup(tracks, "uri", "uri", "track_key", heavy=0.01)])


def q_dq_report_compiled(spark, sf):
    """The mart checks of ``dq_report``, each mart read once."""
    fact, dims = staged_fact_and_dims(spark, sf)
    weekly = stage(weekly_trend(fact), "weekly_trend")
    by_name = stage(artist_popularity_by_name(fact, dims["dim_artist"]), "artist_popularity_by_name")
    return compiled_mart_checks(weekly, by_name)


def _three_loads(spark, sf, group: list[str], measures) -> DataFrame:
    """Two parts of the fact, the first with wrong measures, and then its correction."""
    used = dict.fromkeys([*group, "date_key", "rank", "streams", *[c for _, c in measures.values()]])
    fact = stage(fact_and_dims(spark, sf)[0].select(*used), "fact")
    mart = IncrementalMart(Catalog(spark, scratch_path(spark, "mart_catalog")).committed("analytics.mart"), group, measures)
    first = F.coalesce(F.col("rank") % 2 == 0, F.lit(True))
    mart.load("even", fact.where(first).withColumn("streams", F.col("streams") + 1000).withColumn("date_key", F.col("date_key") + 1))
    mart.load("odd", fact.where(~first))
    mart.load("even", fact.where(first))
    return mart.read(DIGITS)


def q_weekly_trend_incremental(spark, sf):
    return _three_loads(spark, sf, ["date_key"], WEEKLY)


def q_artist_streams_incremental(spark, sf):
    return _three_loads(spark, sf, ["artist_key"], ARTIST)


def q_model_marts(spark, sf):
    """Both marts as declared models: the base a view, the marts tables (the trend in the order of its key)."""
    fact, dims = staged_fact_and_dims(spark, sf)
    models = [Model("weekly", ("base",), lambda base: weekly_trend(base, DIGITS, ordered=True), "table"),
              Model("by_name", ("base", "artists"), lambda base, artists: artist_popularity_by_name(base, artists, DIGITS), "table"),
              Model("base", ("fact",), base_fact),
              Model("report", ("weekly", "by_name"), lambda weekly, by_name: weekly.select(
                  F.lit("weekly_trend").alias("mart"), F.col("date_key").cast("string").alias("name"), "total_streams", "avg_rank").unionByName(
                  by_name.select(F.lit("artist_popularity_by_name").alias("mart"), F.col("artist_name").alias("name"), "total_streams", "avg_rank")), "ephemeral")]
    return run_models(models, {"fact": fact, "artists": dims["dim_artist"]}, ["report"], prefix=f"m{uuid.uuid4().hex}_")["report"]


def q_ensure_table(spark, sf):
    """A table made with a fixed schema, filled by two appends, and left alone when it is ensured again."""
    orders = B.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    name = f"orders_{uuid.uuid4().hex}"
    for part in (orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'").select("o_orderstatus", "o_orderkey", "o_custkey")):
        ensure_table(spark, name, orders.schema)
        write_append(part, name)
    return spark.table(name)


def queries() -> dict[str, Query]:
    return {
        "land_as_strings": q_land_as_strings,
        "scan_csv_format": q_scan_csv_format,
        "clean_chart": chart_clean,
        "clean_release": release_clean,
        "strip_prefix": q_strip_prefix,
        "try_cast_int": q_try_cast_int,
        "try_cast_float": q_try_cast_float,
        "try_parse_date": q_try_parse_date,
        "safe_ratio": q_safe_ratio,
        "filter_null_semantics": q_filter_null_semantics,
        "purge_dups_single_key": chart_purged,
        "purge_dups_tuple_key": q_purge_tuple_key,
        "anti_join_null_keys": lambda spark, sf: chart_purged(spark, sf).filter(F.col("uri").isNull()),
        "flag_duplicates": q_flag_duplicates,
        "drop_exact_duplicates": q_drop_exact_duplicates,
        "latest_per_key": q_latest_per_key,
        "union_distinct": q_union_distinct,
        "surrogate_key": q_surrogate_key,
        "dim_artist": q_dim_artist,
        "dim_track": q_dim_track,
        "dim_country": q_dim_country,
        "dim_date": q_dim_date,
        "dim_audio_features": q_dim_audio,
        "dim_audio_features_double_strip": q_dim_audio_double_strip,
        "keep_one_chart": q_keep_one_chart,
        "fact_date_lookup": q_fact_date_lookup,
        "chart_calendar": q_chart_calendar,
        "weekend_releases": q_weekend_releases,
        "fact_star_join": q_fact_star_join,
        "fact_star_join_first": q_fact_star_join_first,
        "fact_build": q_fact_build,
        "base_fact": q_base_fact,
        "weekly_trend": q_weekly_trend,
        "artist_streams": q_artist_streams,
        "artist_popularity_by_key": q_artist_popularity_by_key,
        "artist_popularity_by_name": q_artist_popularity_by_name,
        "incremental_slice": q_incremental_slice,
        "merge_upsert_artist": q_merge_upsert_artist,
        "merge_upsert_artist_stale_insert": q_merge_upsert_artist_stale_insert,
        "merge_upsert_track": q_merge_upsert_track,
        "scd2_snapshot": q_scd2_snapshot,
        "scd2_hard_delete": q_scd2_hard_delete,
        "dq_not_null": q_dq_not_null,
        "dq_unique": q_dq_unique,
        "dq_report": q_dq_report,
        "dq_primary_key": q_dq_primary_key,
        "dq_foreign_key": q_dq_foreign_key,
        "dq_fanout": q_dq_fanout,
        "flatten_release_pages": q_flatten_release_pages,
        "variant_items": q_variant_items,
        "variant_quarantine": q_variant_quarantine,
        "snapshot_colocated": q_snapshot_colocated,
        "array_flatten_names": q_array_flatten_names,
        "collab_flag": q_collab_flag,
        "enrich_artist": q_enrich_artist,
        "infer_country": q_infer_country,
        "rolling_week_filter": q_rolling_week_filter,
        "clean_weekly": q_clean_weekly,
        "run_weekly_load": q_run_weekly_load,
        "run_chart_clean": q_run_chart_clean,
        "run_release_clean": q_run_release_clean,
        "run_fact": q_run_fact,
        "stream_dedup": q_stream_dedup,
        "stream_upsert": q_stream_upsert,
        "stream_release_load": q_stream_release_load,
        "dq_fact_foreign_keys": q_dq_fact_foreign_keys,
        "run_dimensions": q_run_dimensions,
        "run_incremental_dims": q_run_incremental_dims,
        "run_marts": q_run_marts,
        "run_snapshot": q_run_snapshot,
        "merge_upsert_track_stale_insert": q_merge_upsert_track_stale_insert,
        "write_tables": q_write_tables,
        "reload_failed": q_reload_failed,
        "reload_conflict": q_reload_conflict,
        "sequence_keys": q_sequence_keys,
        "merge_bucketed_artist": q_merge_bucketed_artist,
        "merge_bucketed_track": q_merge_bucketed_track,
        "purge_appended_loads": q_purge_appended_loads,
        "stream_merge": q_stream_merge,
        "stream_dedup_state": q_stream_dedup_state,
        "stream_late_rows": q_stream_late_rows,
        "fact_skew_lookup": q_fact_skew_lookup,
        "model_marts": q_model_marts,
        "ensure_table": q_ensure_table,
        "dq_report_compiled": q_dq_report_compiled,
        "weekly_trend_incremental": q_weekly_trend_incremental,
        "artist_streams_incremental": q_artist_streams_incremental,
    }
