"""Randomised properties: dense keys, SCD2 validity, idempotent upsert."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from chartmart.operators.history import scd2_snapshot
from chartmart.operators.keys import assign_surrogate_keys
from chartmart.operators.upsert import merge_upsert, src

small_text = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "dd", ""]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(small_text, st.one_of(st.none(), st.integers(-3, 3))), max_size=40),
       st.integers(1, 5))
def test_keys_dense_and_match_row_number(spark, data, parts):
    df = spark.createDataFrame(data, "a string, b bigint").distinct()
    out = assign_surrogate_keys(df, ["a", "b"], "k", num_partitions=parts)
    got = sorted(tuple(r) for r in out.collect())
    w = Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
    exp = sorted(tuple(r) for r in df.select(F.row_number().over(w).cast("bigint").alias("k"), "a", "b").collect())
    assert got == exp
    assert [r[0] for r in got] == list(range(1, len(got) + 1))


SRC = "k bigint, v string, updated_at timestamp_ntz"
DAYS = [dt.datetime(2024, 1, d) for d in range(1, 6)]
load = st.lists(st.tuples(st.integers(1, 6), st.sampled_from(["x", "y"]), st.sampled_from(DAYS)), max_size=6)


@settings(max_examples=8, deadline=None)
@given(st.lists(load, min_size=1, max_size=4))
def test_scd2_one_open_row_and_no_overlap(spark, loads):
    snap = None
    for i, rows in enumerate(loads):
        uniq = {}
        for k, v, t in rows:  # a source holds one row per key
            uniq[k] = (k, v, t)
        cur = spark.createDataFrame(list(uniq.values()), SRC)
        snap = scd2_snapshot(snap, cur, ["k"], "updated_at", dt.datetime(2024, 2, 1 + i))
        snap = spark.createDataFrame(snap.collect(), snap.schema)  # materialise each run
    got = snap.collect()
    open_rows = [r for r in got if r["valid_to"] is None]
    assert len(open_rows) == len({r["k"] for r in open_rows})
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        closed = sorted([r for r in versions if r["valid_to"] is not None], key=lambda r: r["valid_from"])
        for r in closed:
            assert r["valid_from"] <= r["valid_to"]


DIM = "key bigint, id string, g string, name string, start timestamp_ntz"
S = "id string, g string, name string, ts timestamp_ntz"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "3"]), st.sampled_from(["p", "q", None])), max_size=5, unique=True),
       st.lists(st.tuples(st.sampled_from(["1", "2", "4"]), st.sampled_from(["p", "q"])), max_size=5, unique=True))
def test_merge_skip_twice_equals_once(spark, target_keys, source_keys):
    """Idempotent for source rows with non-NULL match keys (a NULL key never matches, so such a
    row is inserted by every run, as in the literal MERGE; see test_null_key_source_row_reinserted)."""
    t = spark.createDataFrame([(i + 1, a, g, "t", dt.datetime(2024, 1, 1)) for i, (a, g) in enumerate(target_keys)], DIM)
    s = spark.createDataFrame([(a, g, "s", dt.datetime(2024, 1, 2)) for a, g in source_keys], S)

    def once(target):
        return merge_upsert(target, s, on=[("id", "id"), ("g", "g")], fresher=("start", "ts"),
                            set_={"name": src("name"), "start": F.lit("2024-01-03").cast("timestamp_ntz")},
                            insert={"id": src("id"), "g": src("g"), "name": src("name"), "start": src("ts")},
                            key="key", on_stale="skip")

    one = once(t)
    two = once(spark.createDataFrame(one.collect(), one.schema))
    strip = lambda df: sorted(tuple(r) for r in df.select("key", "id", "g", "name").collect())
    assert strip(one) == strip(two)


def test_null_key_source_row_reinserted(spark):
    t = spark.createDataFrame([], DIM)
    s = spark.createDataFrame([("1", None, "s", dt.datetime(2024, 1, 2))], S)
    run = lambda target: merge_upsert(target, s, on=[("id", "id"), ("g", "g")], set_={},
                                      insert={"id": src("id"), "g": src("g"), "name": src("name")},
                                      key="key", on_stale="skip")
    one = run(t)
    two = run(spark.createDataFrame(one.collect(), one.schema))
    assert sorted(r["key"] for r in two.collect()) == [1, 2]


CHART_F = ("uri string, artist_id string, country string, week date, rank bigint, peak_rank bigint, "
           "previous_rank bigint, weeks_on_chart bigint, streams bigint")
nat_u = st.sampled_from(["u1", "u2", "u9", None])      # u9 is missing from the track dimension
nat_a = st.sampled_from(["a1", "a2", None])
meas = st.integers(0, 2)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(nat_u, nat_a, st.sampled_from(["X", "Y"]), st.sampled_from([1, 2]), meas, meas),
                min_size=1, max_size=14),
       st.lists(st.sampled_from(["u1", "u2"]), min_size=1, max_size=3),
       st.lists(st.sampled_from(["a1", "a2"]), min_size=1, max_size=3))
def test_purge_before_fanout_equals_fact_purge(spark, rows_, track_nats, artist_nats):
    from chartmart.operators.dims import build_dim_date
    from chartmart.plans.flows import run_fact

    chart = spark.createDataFrame(
        [(u, a, c, dt.date(1990, 1, w), r, 1, 1, 1, s) for u, a, c, w, r, s in rows_], CHART_F)
    dims = {
        "dim_track": spark.createDataFrame([(i + 1, n) for i, n in enumerate(track_nats)], "track_key bigint, uri string"),
        "dim_artist": spark.createDataFrame([(i + 1, n) for i, n in enumerate(artist_nats)],
                                            "artist_key bigint, artist_id string"),
        "dim_country": spark.createDataFrame([(1, "X")], "country_key bigint, country string"),
        "dim_date": build_dim_date(spark),
    }
    for lookup in ("all", "first"):
        late = sorted(map(tuple, run_fact(chart, dims, lookup=lookup, purge_early=False).collect()), key=str)
        early = sorted(map(tuple, run_fact(chart, dims, lookup=lookup, purge_early=True).collect()), key=str)
        assert early == late
