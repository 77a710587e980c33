import datetime as dt

from pyspark.sql import functions as F

from chartmart.operators.history import scd2_snapshot
from chartmart.operators.upsert import upsert_dim_artist
from conftest import rows

DIM = ("artist_key bigint, artist_id string, artist_name string, artist_genre string, artist_img string, "
       "effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, is_current boolean")
REL = ("uri string, artist_names string, artists_num bigint, artist_individual string, artist_id string, "
       "artist_genre string, artist_img string, collab bigint, track_name string, release_date date, "
       "album_num_tracks bigint, album_cover string, region string, load_timestamp timestamp_ntz")
T0, T1 = dt.datetime(2024, 12, 1), dt.datetime(2024, 12, 1, 6)
DAY = dt.date(2024, 11, 15)


def rel(uri, aid, name, genre, img, day=DAY, ts=T1):
    return (uri, name, 1, name, aid, genre, img, 0, "t", day, 1, "c", "Global", ts)


def dim(spark, data):
    return spark.createDataFrame(data, DIM)


def run(spark, target, source, on_stale):
    return upsert_dim_artist(target, spark.createDataFrame(source, REL), "2024-11-15", "2024-12-02 00:00:00", on_stale)


def test_update_insert_and_other_days_ignored(spark):
    t = dim(spark, [(1, "a", "old", "pop", "i0", T0, None, True)])
    src = [rel("u1", "a", "new", "pop", "i1"), rel("u2", "b", "B", "rock", "j"),
           rel("u3", "c", "C", "x", "k", day=dt.date(2024, 11, 14))]
    out = rows(run(spark, t, src, "skip").select("artist_key", "artist_id", "artist_name", "artist_img",
                                                 "effective_start_date"))
    assert out == [(1, "a", "new", "i1", dt.datetime(2024, 12, 2)), (2, "b", "B", "j", None)]


def test_stale_row_insert_vs_skip(spark):
    t = dim(spark, [(7, "a", "old", "pop", "i0", dt.datetime(2030, 1, 1), None, True)])
    src = [rel("u1", "a", "new", "pop", "i1")]
    assert rows(run(spark, t, src, "skip").select("artist_key", "artist_name")) == [(7, "old")]
    assert rows(run(spark, t, src, "insert").select("artist_key", "artist_name")) == [(7, "old"), (8, "new")]


def test_null_start_and_null_genre_never_match(spark):
    t = dim(spark, [(1, "a", "old", "pop", "i0", None, None, True), (2, "b", "old", None, "i0", T0, None, True)])
    src = [rel("u1", "a", "new", "pop", "i1"), rel("u2", "b", "newb", None, "i2")]
    out = rows(run(spark, t, src, "insert").select("artist_key", "artist_id", "artist_name"))
    assert out == [(1, "a", "old"), (2, "b", "old"), (3, "a", "new"), (4, "b", "newb")]


def test_merge_twice_with_skip_equals_once(spark):
    t = dim(spark, [(1, "a", "old", "pop", "i0", T0, None, True)])
    src = [rel("u1", "a", "new", "pop", "i1"), rel("u2", "b", "B", "rock", "j")]
    once = run(spark, t, src, "skip")
    twice = run(spark, once, src, "skip")
    cols = ["artist_key", "artist_id", "artist_name", "artist_genre", "artist_img"]
    assert rows(once.select(*cols)) == rows(twice.select(*cols))


SRC = "k bigint, v string, updated_at timestamp_ntz"
D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def test_scd2_changes_need_newer_updated_at(spark):
    s1 = scd2_snapshot(None, spark.createDataFrame([(1, "x", D1), (2, "y", D1)], SRC), ["k"], "updated_at", "2024-01-02")
    s2 = scd2_snapshot(s1, spark.createDataFrame([(1, "x2", D1), (2, "y2", D2)], SRC), ["k"], "updated_at",
                       "2024-02-02")
    got = rows(s2.select("k", "v", "valid_from", "valid_to"))
    assert got == [(1, "x", D1, None), (2, "y", D1, D2), (2, "y2", D2, None)]


def test_scd2_hard_delete_then_return(spark):
    load = spark.createDataFrame([(1, "x", D1), (2, "y", D1)], SRC)
    s1 = scd2_snapshot(None, load, ["k"], "updated_at", "2024-01-02")
    s2 = scd2_snapshot(s1, load.filter("k = 1"), ["k"], "updated_at", "2024-02-02")
    s3 = scd2_snapshot(s2, load, ["k"], "updated_at", "2024-03-02")
    got = rows(s3.select("k", "valid_from", "valid_to"))
    assert got == [(1, D1, None), (2, D1, dt.datetime(2024, 2, 2)), (2, D1, None)]
    open_per_key = s3.filter(F.col("valid_to").isNull()).groupBy("k").count().filter("count > 1").count()
    assert open_per_key == 0


def test_merge_rejects_ambiguous_source(spark):
    import pytest

    from chartmart.operators.upsert import merge_upsert, src

    t = dim(spark, [(1, "a", "old", "pop", "i0", T0, None, True)])
    s = spark.createDataFrame(
        [rel("u1", "a", "x", "pop", "i1"), rel("u2", "a", "y", "pop", "i2")], REL)
    with pytest.raises(ValueError):
        merge_upsert(t, s, on=[("artist_id", "artist_id"), ("artist_genre", "artist_genre")],
                     set_={"artist_name": src("artist_individual")}, insert={}, key="artist_key")


def test_incremental_snapshot_storage_equals_full_snapshot(spark):
    import tempfile

    from chartmart.plans.flows import run_snapshot
    from chartmart.sources.catalog import Catalog

    cat = Catalog(spark, tempfile.mkdtemp(prefix="chartmart-snap-"))
    loads = [spark.createDataFrame([(1, "x", D1), (2, "y", D1), (3, "z", D1)], SRC),
             spark.createDataFrame([(1, "x2", D2), (2, "y", D1)], SRC),
             spark.createDataFrame([(1, "x2", D2), (3, "z", D1)], SRC)]
    full = None
    for i, load in enumerate(loads):
        as_of = f"2024-0{i + 2}-15"
        full = scd2_snapshot(full, load, ["k"], "updated_at", as_of)
        full = spark.createDataFrame(full.collect(), full.schema)
        split = run_snapshot(cat, "analytics.snap", load, ["k"], "updated_at", as_of)
        assert rows(split) == rows(full)
    assert spark.read.parquet(cat.location("analytics.snap") + "/run=20240415/open").filter(F.col("valid_to").isNotNull()).count() == 0


def test_snapshot_rejects_duplicate_source_keys(spark):
    import pytest

    dup = spark.createDataFrame([(1, "x", D1), (1, "y", D1)], SRC)
    with pytest.raises(ValueError):
        scd2_snapshot(None, dup, ["k"], "updated_at", "2024-01-02")


def _snapshot_loads(spark):
    return [(spark.createDataFrame([(1, "x", D1), (2, "y", D1), (3, "z", D1)], SRC), "2024-02-15"),
            (spark.createDataFrame([(1, "x2", D2), (2, "y", D1)], SRC), "2024-03-15"),
            (spark.createDataFrame([(1, "x2", D2), (3, "z", D1)], SRC), "2024-04-15")]


def test_snapshot_run_again_after_a_crash_gives_the_same(spark):
    """A run that stops after its closed rows, or after all, and is repeated: nothing lost, nothing doubled."""
    import os
    import tempfile

    from chartmart.plans.flows import run_snapshot
    from chartmart.sources.catalog import Catalog

    clean, broken = (Catalog(spark, tempfile.mkdtemp(prefix="chartmart-snap-")) for _ in range(2))
    for load, as_of in _snapshot_loads(spark):
        expected = rows(run_snapshot(clean, "analytics.s", load, ["k"], "updated_at", as_of))
        run_snapshot(broken, "analytics.s", load, ["k"], "updated_at", as_of)
        part = f"{broken.location('analytics.s')}/run={as_of.replace('-', '')}/open"
        os.remove(f"{part}/_SUCCESS")  # as if the run had ended between its two parts
        assert rows(run_snapshot(broken, "analytics.s", load, ["k"], "updated_at", as_of)) == expected
        assert rows(run_snapshot(broken, "analytics.s", load, ["k"], "updated_at", as_of)) == expected


def test_snapshot_read_error_is_raised_and_keeps_history(spark):
    import glob
    import tempfile

    import pytest

    from chartmart.plans.flows import run_snapshot
    from chartmart.sources.catalog import Catalog

    cat = Catalog(spark, tempfile.mkdtemp(prefix="chartmart-snap-"))
    loads = _snapshot_loads(spark)
    for load, as_of in loads[:2]:
        run_snapshot(cat, "analytics.s", load, ["k"], "updated_at", as_of)
    folder = cat.location("analytics.s")
    for f in glob.glob(f"{folder}/run=20240315/open/*.parquet"):
        with open(f, "wb") as damaged:
            damaged.write(b"not parquet")
    before = sorted(glob.glob(f"{folder}/**", recursive=True))
    with pytest.raises(Exception):
        run_snapshot(cat, "analytics.s", loads[2][0], ["k"], "updated_at", loads[2][1])
    assert sorted(glob.glob(f"{folder}/**", recursive=True)) == before
