"""MERGE-style incremental upsert of a dimension, as joins and a union.

Plain parquet has no row-level MERGE, so an upsert produces the *new version* of the
dimension; the caller writes it to a new location and publishes it (never overwriting a
path the same plan reads).

Plan: one LEFT join of the target with the (small, one-run-date) source on the equality
keys. Each target row meets at most one source row because the source is unique on the
keys (use ``latest_per_key`` first). Matched rows whose freshness test holds take the
update expressions. Inserts are the source rows left over: an anti join of the source
against the (small) set of source keys that matched, so the large target is scanned,
never shuffled against itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.operators.dedup import latest_per_key
from chartmart.operators.keys import assign_surrogate_keys, next_key
from chartmart.session import stage

SRC = "_src_"


def src(c: str) -> Column:
    """Reference a source column inside ``set_``/``insert`` expressions."""
    return F.col(SRC + c)


def merge_upsert(target: DataFrame, source: DataFrame, on: Sequence[tuple[str, str]],
                 set_: Mapping[str, Column], insert: Mapping[str, Column], key: str,
                 fresher: tuple[str, str] | None = None, on_stale: str = "skip",
                 insert_order: Sequence[str] | None = None, check_unique_source: bool = True,
                 number: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """Upsert ``source`` into ``target``.

    on        pairs (target column, source column) compared with ``=``; a NULL never matches,
              so a source row with a NULL key part is inserted by every run (literal MERGE)
    fresher   (target column, source column): a match also needs target < source; a NULL
              on either side fails it
    set_      target column -> expression over ``src(...)`` for matched rows
    insert    target column -> expression over ``src(...)`` for new rows (``key`` is generated)
    on_stale  "insert": a row that fails only the freshness test is *not matched* and is
              inserted as a second row (the literal MERGE); "skip": it is left out
    number    gives new rows their keys, from the rows and their order; by default the keys
              after the target's greatest

    The source must hold at most one row per ``on`` key (otherwise a target row would
    match twice, which a warehouse MERGE rejects as nondeterministic); this is checked on
    the source (one small aggregation) unless ``check_unique_source`` is False.
    """
    if on_stale not in ("insert", "skip"):
        raise ValueError("on_stale must be 'insert' or 'skip'")
    if check_unique_source:
        s_keys = [s_col for _, s_col in on]
        all_set = F.lit(True)
        for c in s_keys:
            all_set = all_set & F.col(c).isNotNull()  # a key with a NULL part never matches anyway
        repeated = source.filter(all_set).groupBy(*s_keys).count().filter(F.col("count") > 1)
        if not repeated.isEmpty():
            raise ValueError(f"merge source holds several rows for one key {s_keys}; reduce it first "
                             "(e.g. latest_per_key)")
    s = source.select(*[F.col(c).alias(SRC + c) for c in source.columns])
    eq = None
    for t_col, s_col in on:
        term = target[t_col] == s[SRC + s_col]
        eq = term if eq is None else eq & term
    joined = target.join(s, eq, "left")
    hit = F.col(SRC + on[0][1]).isNotNull()
    for _, s_col in on[1:]:
        hit = hit & F.col(SRC + s_col).isNotNull()
    if fresher:
        fresh = F.coalesce(F.col(fresher[0]) < F.col(SRC + fresher[1]), F.lit(False))
    else:
        fresh = F.lit(True)
    matched = hit & fresh

    updated = joined.select(*[
        (F.when(matched, set_[c]).otherwise(F.col(c)) if c in set_ else F.col(c)).cast(target.schema[c].dataType).alias(c)
        for c in target.columns])

    consumed = matched if on_stale == "insert" else hit
    used_keys = joined.filter(consumed).select(*[F.col(SRC + s_col).alias(s_col) for _, s_col in on]).distinct()
    new_rows = source.join(used_keys, [s_col for _, s_col in on], "left_anti")
    new_src = new_rows.select(*[F.col(c).alias(SRC + c) for c in new_rows.columns])
    ins = new_src.select(*[
        (insert[c] if c in insert else F.lit(None)).cast(target.schema[c].dataType).alias(c)
        for c in target.columns if c != key])
    order = list(insert_order) if insert_order else [c for c in ins.columns]
    keyed = number(ins, order) if number else assign_surrogate_keys(ins, order, key, start=next_key(target, key))
    return updated.unionByName(keyed.select(*target.columns))


def select_run_date(df: DataFrame, col: str, run_date: str) -> DataFrame:
    """Rows of one logical run date, compared as a DATE (a pushed-down parquet filter)."""
    return df.filter(F.col(col) == F.lit(str(run_date)).cast("date"))


def artist_day(release_clean: DataFrame, run_date: str) -> DataFrame:
    """The latest release row per artist of the run date, staged."""
    return stage(latest_per_key(select_run_date(release_clean, "release_date", run_date), ["artist_id"],
                                ["release_date", "load_timestamp", "uri", "artist_individual", "artist_genre", "artist_img"]), "day")


def artist_merge(as_of: datetime | str) -> dict:
    """Match on id, genre and freshness; update name/image/start; insert with NULL start, current."""
    from chartmart.operators.dims import ts_lit

    return {
        "on": [("artist_id", "artist_id"), ("artist_genre", "artist_genre")],
        "fresher": ("effective_start_date", "load_timestamp"),
        "set_": {"artist_name": src("artist_individual"), "artist_img": src("artist_img"),
                 "effective_start_date": ts_lit(as_of)},
        "insert": {"artist_id": src("artist_id"), "artist_name": src("artist_individual"),
                   "artist_genre": src("artist_genre"), "artist_img": src("artist_img"),
                   "effective_start_date": ts_lit(None), "effective_end_date": ts_lit(None),
                   "is_current": F.lit(True)},
        "key": "artist_key", "insert_order": ["artist_id", "artist_name", "artist_genre", "artist_img"]}


def track_day(release_clean: DataFrame, run_date: str) -> DataFrame:
    """The latest release row per uri of the run date, staged."""
    return stage(latest_per_key(select_run_date(release_clean, "release_date", run_date), ["uri"],
                                ["release_date", "load_timestamp", "track_name", "album_cover", "album_num_tracks",
                                 "artist_id"]), "day")


def track_merge(as_of: datetime | str) -> dict:
    """Match on uri, name and freshness; update cover/track count/start; insert with start = run time."""
    from chartmart.operators.dims import ts_lit

    return {
        "on": [("uri", "uri"), ("track_name", "track_name")],
        "fresher": ("effective_start_date", "load_timestamp"),
        "set_": {"album_cover": src("album_cover"), "album_num_tracks": src("album_num_tracks"),
                 "effective_start_date": ts_lit(as_of)},
        "insert": {"uri": src("uri"), "track_name": src("track_name"), "release_date": src("release_date"),
                   "album_cover": src("album_cover"), "album_num_tracks": src("album_num_tracks"),
                   "effective_start_date": ts_lit(as_of)},
        "key": "track_key", "insert_order": ["uri", "track_name", "release_date", "album_cover", "album_num_tracks"]}


def upsert_dim_artist(dim_artist: DataFrame, release_clean: DataFrame, run_date: str,
                      as_of: datetime | str, on_stale: str = "skip") -> DataFrame:
    """Daily artist upsert of the run date's releases."""
    return merge_upsert(dim_artist, artist_day(release_clean, run_date), on_stale=on_stale, **artist_merge(as_of))


def upsert_dim_track(dim_track: DataFrame, release_clean: DataFrame, run_date: str,
                     as_of: datetime | str, on_stale: str = "skip") -> DataFrame:
    """Daily track upsert of the run date's releases."""
    return merge_upsert(dim_track, track_day(release_clean, run_date), on_stale=on_stale, **track_merge(as_of))
