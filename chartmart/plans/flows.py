"""User-facing runs (M1-M7): compositions of the operators, one lazy plan per stage.

Stage outputs that several consumers read (cleaned chart, dimensions, fact) are written
once to shared storage (``stage``) and read back, which cuts lineage, survives executor
loss, and avoids recomputing the upstream joins for each consumer.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.operators.clean import CHART_COMPARE, CHART_SPEC, RELEASE_COMPARE, RELEASE_SPEC, WEEKLY_SPEC, clean
from chartmart.operators.compiled_checks import Check, run_compiled
from chartmart.operators.dedup import drop_exact_duplicates, purge_duplicated_keys, purge_in_slices
from chartmart.operators.dims import (build_dim_artist, build_dim_audio, build_dim_country, build_dim_date,
                                      build_dim_track, ts_lit)
from chartmart.operators.fact import FACT_KEYS, build_fact, purge_before_fanout
from chartmart.operators.history import _first_version, check_unique_keys, scd2_snapshot, scd2_step
from chartmart.operators.marts import artist_popularity_by_key, artist_popularity_by_name, weekly_trend
from chartmart.operators.quality import check_not_null, check_result, check_type, check_unique, run_checks
from chartmart.operators.upsert import upsert_dim_artist, upsert_dim_track
from chartmart.operators.weekly import enrich_artist, flatten_pages, weekly_rows
from chartmart.schemas import FACT_COLUMNS, RAW_CHART, RAW_RELEASE
from chartmart.session import stage
from chartmart.sources.files import FileFormat, scan_csv
from chartmart.sources.versions import complete

# Fixed run clock of the repeatable runs (never current_timestamp inside a compared query).
HIST_AS_OF = "2024-12-01 00:00:00"      # historical dimension load
RELEASE_LOAD_TS = "2024-12-01 06:00:00"  # load time stamped on the cleaned release rows
MERGE_AS_OF = "2024-12-02 00:00:00"      # daily incremental upsert
RUN_DATE = "2024-11-15"                  # logical date of the incremental run
WEEKLY_AS_OF = "2024-11-15"              # "today" of the weekly load


def dedup(df: DataFrame, key_cols: list[str], compare_cols: list[str], how: str,
          keep_order: list[str] | None = None) -> DataFrame:
    """``purge``: delete every row of a repeated key; ``keep_one``: one row per repeated group
    (the smallest in ``keep_order`` when columns outside the comparison may differ)."""
    if how == "purge":
        return purge_duplicated_keys(df, key_cols, compare_cols)
    if how == "keep_one":
        return drop_exact_duplicates(df, compare_cols, order=keep_order)
    if how == "none":
        return df
    raise ValueError("dedup must be 'purge', 'keep_one' or 'none'")


def clean_chart(raw: DataFrame, dedup_how: str = "purge") -> DataFrame:
    """Typed chart rows, staged once (the cleanup reads them several times), then deduplicated."""
    typed = clean(raw, CHART_SPEC)
    if dedup_how == "purge":
        return purge_duplicated_keys(typed, ["uri"], CHART_COMPARE, store="chart_clean")
    if dedup_how != "none":
        typed = stage(typed, "chart_clean")
    # rows equal on the comparison columns may differ in rank: keep-one keeps the lowest rank
    return dedup(typed, ["uri"], CHART_COMPARE, dedup_how, keep_order=["rank"])


def clean_release(raw: DataFrame, load_ts: datetime | str = RELEASE_LOAD_TS, dedup_how: str = "purge") -> DataFrame:
    typed = clean(raw, RELEASE_SPEC, load_timestamp=ts_lit(load_ts))
    if dedup_how == "purge":
        return purge_duplicated_keys(typed, ["uri"], RELEASE_COMPARE, store="release_clean")
    if dedup_how != "none":
        typed = stage(typed, "release_clean")
    return dedup(typed, ["uri"], RELEASE_COMPARE, dedup_how)


def stage_release(release: DataFrame) -> DataFrame:
    """Cleaned release rows laid out by release date: a run-date slice reads one directory."""
    return stage(release, "release_purged", partition_by=["release_date"])


def run_historical_chart(spark: SparkSession, path: str, dedup_how: str = "purge",
                         fmt: FileFormat = FileFormat()) -> DataFrame:
    """M1: chart CSV -> all-string landing rows -> typed rows -> duplicate cleanup."""
    return clean_chart(scan_csv(spark, path, RAW_CHART, fmt), dedup_how)


def run_historical_release(spark: SparkSession, path: str, load_ts: datetime | str = RELEASE_LOAD_TS,
                           dedup_how: str = "purge", fmt: FileFormat = FileFormat()) -> DataFrame:
    """M2: release CSV -> landing rows -> typed rows + load time -> duplicate cleanup."""
    return clean_release(scan_csv(spark, path, RAW_RELEASE, fmt), load_ts, dedup_how)


def run_dimensions(spark: SparkSession, chart: DataFrame, release: DataFrame,
                   as_of: datetime | str = HIST_AS_OF, concurrent: bool = True,
                   which: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """M3: the five dimensions. Each keyed dimension is frozen in shared storage by the key step.

    The dimensions are independent, so their jobs are submitted together from a small thread
    pool (Spark schedules concurrent jobs; small dimensions no longer leave cores idle)."""
    builders = {
        "dim_artist": lambda: build_dim_artist([chart, release], as_of),
        "dim_track": lambda: build_dim_track([chart, release], as_of),
        "dim_country": lambda: build_dim_country(chart),
        "dim_date": lambda: build_dim_date(spark),
        "dim_audio_features": lambda: build_dim_audio(chart),
    }
    if which is not None:
        builders = {k: builders[k] for k in which}
    if not concurrent:
        return {k: f() for k, f in builders.items()}
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        futures = {k: pool.submit(f) for k, f in builders.items()}
        return {k: fut.result() for k, fut in futures.items()}


def run_incremental_dims(dims: dict[str, DataFrame], release: DataFrame, run_date: date | str = RUN_DATE,
                         as_of: datetime | str = MERGE_AS_OF, on_stale: str = "skip") -> dict[str, DataFrame]:
    """M4: upsert the run date's releases into the artist and track dimensions."""
    out = dict(dims)
    with ThreadPoolExecutor(max_workers=2) as pool:  # the two upserts are independent jobs
        artist = pool.submit(lambda: stage(upsert_dim_artist(dims["dim_artist"], release, str(run_date), as_of,
                                                             on_stale), "dim_artist"))
        track = pool.submit(lambda: stage(upsert_dim_track(dims["dim_track"], release, str(run_date), as_of,
                                                           on_stale), "dim_track"))
        out["dim_artist"], out["dim_track"] = artist.result(), track.result()
    return out


def run_fact(chart: DataFrame, dims: dict[str, DataFrame], dedup_how: str = "purge", lookup: str = "all",
             purge_early: bool = True) -> DataFrame:
    """M5: star lookup + measures, then the fact's duplicate cleanup on its four keys.

    ``purge_early`` applies the same purge to the chart rows before the lookups fan them out
    (``purge_before_fanout``: identical result, far fewer rows grouped)."""
    d = (dims["dim_track"], dims["dim_artist"], dims["dim_country"], dims["dim_date"])
    if dedup_how == "purge" and purge_early:
        return build_fact(purge_before_fanout(chart, *d), *d, lookup)
    if dedup_how == "purge":
        return purge_in_slices(build_fact(chart, *d, lookup), FACT_KEYS, FACT_COLUMNS, "fact_rows")
    return dedup(build_fact(chart, *d, lookup), FACT_KEYS, FACT_COLUMNS, dedup_how)


def mart_checks(weekly: DataFrame, artists: DataFrame) -> DataFrame:
    """The column tests of the two marts as one report."""
    return run_checks([
        check_result(check_not_null(artists, "artist_name"), "not_null_streams_popularity_artist_artist_name"),
        check_result(check_unique(artists, "artist_name"), "unique_streams_popularity_artist_artist_name"),
        check_result(check_not_null(artists, "total_streams"), "not_null_streams_popularity_artist_total_streams"),
        check_type(artists, "total_streams", "number", "type_number_streams_popularity_artist_total_streams"),
        check_type(artists, "avg_rank", "number", "type_number_streams_popularity_artist_avg_rank"),
        check_type(artists, "avg_popularity", "number", "type_number_streams_popularity_artist_avg_popularity"),
        check_result(check_not_null(weekly, "date_key"), "not_null_weekly_trend_analysis_date_key"),
        check_result(check_unique(weekly, "date_key"), "unique_weekly_trend_analysis_date_key"),
        check_result(check_not_null(weekly, "total_streams"), "not_null_weekly_trend_analysis_total_streams"),
        check_type(weekly, "total_streams", "number", "type_number_weekly_trend_analysis_total_streams"),
        check_type(weekly, "avg_rank", "number", "type_number_weekly_trend_analysis_avg_rank"),
    ])


def _number(column: str, table: str) -> Check:
    return Check("type", column, f"type_number_{table}_{column}", "number")


def compiled_mart_checks(weekly: DataFrame, artists: DataFrame) -> DataFrame:
    """``mart_checks`` from one scan of each mart."""
    a, w = "streams_popularity_artist", "weekly_trend_analysis"
    return run_compiled([
        (artists, [Check("not_null", "artist_name", f"not_null_{a}_artist_name"), Check("unique", "artist_name", f"unique_{a}_artist_name"),
                   Check("not_null", "total_streams", f"not_null_{a}_total_streams"),
                   *[_number(c, a) for c in ("total_streams", "avg_rank", "avg_popularity")]]),
        (weekly, [Check("not_null", "date_key", f"not_null_{w}_date_key"), Check("unique", "date_key", f"unique_{w}_date_key"),
                  Check("not_null", "total_streams", f"not_null_{w}_total_streams"), *[_number(c, w) for c in ("total_streams", "avg_rank")]]),
    ])


def run_marts(fact: DataFrame, dim_artist: DataFrame, prev_snapshot: DataFrame | None = None,
              snapshot_source: DataFrame | None = None, snapshot_key: list[str] | None = None,
              as_of: datetime | str = HIST_AS_OF, ndigits: int | None = None) -> dict[str, DataFrame]:
    """M6: marts (small aggregates, staged once), their column tests, and an optional snapshot."""
    with ThreadPoolExecutor(max_workers=2) as pool:  # two independent aggregations of the fact
        w = pool.submit(lambda: stage(weekly_trend(fact, ndigits), "weekly_trend"))
        n = pool.submit(lambda: stage(artist_popularity_by_name(fact, dim_artist, ndigits), "artist_popularity_by_name"))
        weekly, by_name = w.result(), n.result()
    out = {
        "weekly_trend": weekly,
        "artist_popularity_by_name": by_name,
        "artist_popularity_by_key": artist_popularity_by_key(fact, dim_artist, ndigits),
        "report": mart_checks(weekly, by_name),
    }
    if snapshot_source is not None:
        out["snapshot"] = scd2_snapshot(prev_snapshot, snapshot_source, snapshot_key or [], "updated_at", as_of)
    return out


def weekly_typed(pages: DataFrame, artists: DataFrame, as_of: date | str = WEEKLY_AS_OF) -> DataFrame:
    """Pages -> flat items -> artist enrichment -> last-7-days rows -> typed rows."""
    return clean(weekly_rows(enrich_artist(flatten_pages(pages), artists), as_of), WEEKLY_SPEC)


def run_weekly_load(pages: DataFrame, artists: DataFrame, as_of: date | str = WEEKLY_AS_OF,
                    dedup_how: str = "purge") -> DataFrame:
    """M7: pages -> flat items -> artist enrichment -> last-7-days rows -> typed -> cleanup."""
    rows = weekly_rows(enrich_artist(flatten_pages(pages), artists), as_of)
    typed = clean(rows, WEEKLY_SPEC)
    if dedup_how != "none":
        typed = stage(typed, "weekly_clean")
    return dedup(typed, ["uri"], list(rows.columns), dedup_how)


def run_snapshot(cat, name: str, current: DataFrame, key_cols: list[str], updated_at: str,
                 as_of: datetime | str) -> DataFrame:
    """Snapshot kept as one version per run, named after ``as_of``: the rows it closed (``closed``)
    and the current versions (``open``), written in this order. A version is complete with its
    ``open`` part. A run reads the open rows of the latest complete earlier version and writes
    only its own, so an interrupted or repeated run rewrites the same version and loses or
    doubles nothing; a read error is raised. Returns the full snapshot: the closed rows of all
    versions up to this one and the open rows of this one.
    """
    check_unique_keys(current, key_cols)
    spark, folder = current.sparkSession, cat.location(name)
    run = re.sub(r"[^0-9]", "", str(as_of))  # sorts as the times do
    earlier = sorted(r for r in complete(spark, folder, "run", last="open") if r < run)
    if earlier:
        open_rows = spark.read.parquet(f"{folder}/run={earlier[-1]}/open")
        closed, next_open = scd2_step(open_rows, current, key_cols, updated_at, as_of)
        both = stage(closed.withColumn("_open", F.lit(False)).unionByName(next_open.withColumn("_open", F.lit(True))),
                     f"{name}_{run}")  # the join of the step runs once for both parts
        closed, next_open = both.where("not _open").drop("_open"), both.where("_open").drop("_open")
    else:
        next_open = _first_version(current, key_cols, updated_at)
        closed = next_open.filter(F.lit(False))
    closed.write.mode("overwrite").parquet(f"{folder}/run={run}/closed")
    next_open.write.mode("overwrite").parquet(f"{folder}/run={run}/open")
    history = spark.read.schema(closed.schema).parquet(*[f"{folder}/run={r}/closed" for r in [*earlier, run]])
    return history.unionByName(spark.read.schema(closed.schema).parquet(f"{folder}/run={run}/open"))
