"""Queries that read a stage more than once compute it once, and store of it what they use."""

import uuid

import pytest

from chartmart import session
from chartmart.operators.incremental_marts import ARTIST, IncrementalMart
from chartmart.operators.marts import artist_streams
from chartmart.plans import registry as R
from chartmart.plans.flows import clean_release
from chartmart.schemas import RELEASE_COLUMNS
from chartmart.session import stage
from chartmart.sources.commits import CommittedTable

FACT = ("track_key long, artist_key long, country_key long, date_key long, rank long, peak_rank long, previous_rank long, "
        "weeks_on_chart long, streams long, popularity_score double")


class Staged(Exception):
    pass


def test_both_upserts_share_one_purged_chart(monkeypatch):
    made = []
    monkeypatch.setattr(R, "chart_purged", lambda *a: made.append(a) or "chart")
    monkeypatch.setattr(R, "release_purged", lambda *a: "release")
    for name in ("build_dim_artist", "build_dim_track"):
        monkeypatch.setattr(R, name, lambda sources, as_of: sources)
    monkeypatch.setattr(R, "run_incremental_dims", lambda dims, *a: dims)
    monkeypatch.setattr(R, "_tall", lambda dims: dims)
    assert R.q_run_incremental_dims(None, "sf") == {"dim_artist": ["chart"], "dim_track": ["chart"]}
    assert len(made) == 1


@pytest.mark.parametrize("query", [R.q_run_marts, R.q_dq_report, R.q_dq_report_compiled, R.q_model_marts])
def test_the_fact_is_stored_before_it_is_read_twice(spark, monkeypatch, query):
    fact = spark.createDataFrame([], FACT)

    def first(df, name, *a):
        raise Staged(df is fact, name)

    monkeypatch.setattr(R, "fact_and_dims", lambda *a: (fact, {"dim_artist": spark.createDataFrame([], "artist_key long, artist_name string")}))
    monkeypatch.setattr(R, "stage", first)
    with pytest.raises(Staged) as e:
        query(spark, "sf")
    assert e.value.args == (True, "fact")


def test_foreign_keys_count_rows_of_grouped_keys(spark, monkeypatch):
    rows = [(t, a, None, 1, 1, 1, 1, 1, 1, 0.5) for t, a in ((1, 1), (1, 9), (7, 9), (7, None), (None, 9), (7, 9))]
    dims = {d: spark.createDataFrame([(1,), (1,), (2,)], f"{k} long") for k, d in R._oracle_dims().items()}
    stored = []
    monkeypatch.setattr(R, "fact_and_dims", lambda *a: (spark.createDataFrame(rows, FACT), dims))
    monkeypatch.setattr(R, "stage", lambda df, name: stored.append(df.columns) or stage(df, name))
    got = {r[0]: (r[1], r[2]) for r in R.q_dq_fact_foreign_keys(spark, "sf").collect()}
    assert got == {"fk_track_key": (3, 1), "fk_artist_key": (4, 1), "fk_country_key": (0, 6), "fk_date_key": (0, 0)}
    assert stored == [list(R._oracle_dims())]


def test_loads_of_a_mart_store_its_columns_only(spark, monkeypatch):
    def first(df, name, *a):
        raise Staged(sorted(df.columns))

    monkeypatch.setattr(R, "fact_and_dims", lambda *a: (spark.createDataFrame([], FACT), {}))
    monkeypatch.setattr(R, "stage", first)
    with pytest.raises(Staged) as e:
        R.q_weekly_trend_incremental(spark, "sf")
    assert e.value.args[0] == ["date_key", "rank", "streams"]


def test_partial_sums_of_whole_columns_are_exact(spark, tmp_path):
    big = 2**62
    values = [(1, big, -1), (1, big - 1, None), (1, -big, -(2**40)), (2, -7, 3), (2, None, 4), (3, None, None), (None, 5, -5)]
    fact = spark.createDataFrame([(1, a, 1, 1, r, 1, 1, 1, s, None if s is None else s / 4) for a, s, r in values], FACT)
    mart = IncrementalMart(CommittedTable(spark, f"file://{tmp_path}/{uuid.uuid4().hex}"), ["artist_key"], ARTIST, buckets=4)
    small = fact.where("artist_key > 1 or artist_key is null")
    mart.load("a", fact.select("artist_key", "streams", "rank", "popularity_score"))
    sums = {r["artist_key"]: (r["_sum_streams"], r["_num_streams"], r["_sum_rank"]) for r in mart.table.read(None, "totals").collect()}
    assert sums == {1: (big - 1, 3, -1 - 2**40), 2: (-7, 1, 7), 3: (0, 0, 0), None: (5, 1, -5)}
    got = sorted(map(str, mart.read(6).where("artist_key > 1 or artist_key is null").collect()))
    assert got == sorted(map(str, artist_streams(small, 6).collect()))


def test_hashes_are_stored_with_the_typed_rows_and_read_alone(spark, monkeypatch):
    columns = RELEASE_COLUMNS
    row = lambda uri, name: tuple({"uri": f"catalog:tracks:{uri}", "track_name": name, "release_date": "05-11-2024"}.get(c) for c in columns)
    raw = spark.createDataFrame([row("a", "x"), row("a", "x"), row("a", "y"), row("b", "x"), row("b", "y")] + 2 * [(None,) * len(columns)],
                                ", ".join(f"{c} string" for c in columns))
    plans = {}

    def seen(df, name, *a):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name, *a)

    monkeypatch.setattr(session, "stage", seen)
    out = clean_release(raw)
    assert "xxhash64" in plans["release_clean"][0] and "xxhash64" not in plans["repeated_hashes"][0]
    assert "ReadSchema: struct<_h1:bigint,_h2:int>" in plans["repeated_hashes"][1]
    assert "xxhash64" not in plans["dup_keys"][0]
    assert sorted((r.uri or "", r.track_name or "") for r in out.collect()) == [("", ""), ("", ""), ("b", "x"), ("b", "y")]
    assert out.columns == [*columns, "load_timestamp"]
