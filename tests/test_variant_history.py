"""Pages landed as VARIANT, and history whose open rows are stored by key."""

import datetime

import pytest
from pyspark.sql import functions as F

from chartmart.operators.history import scd2_snapshot
from chartmart.operators.stored_history import StoredHistory
from chartmart.operators.variant_pages import flatten_variant_pages, landed, parse_pages, quarantined
from chartmart.operators.weekly import flatten_pages
from chartmart.schemas import PAGE
from chartmart.session import scratch_path
from chartmart.sources.commits import Conflict

GOOD = ('{"tracks":{"items":[{"uri":"u1","name":"n1","album":{"release_date":"2024-11-01","total_tracks":3,"label":"l","images":[{"url":"i"}]},'
        '"artists":[{"name":"a","id":"1"},{"name":"b","id":"2"}]},{"uri":"u2","artists":[]}]}}')


def test_variant_pages_equal_the_fixed_schema(spark):
    texts = spark.createDataFrame([(GOOD,), ('{"tracks":{"items":[]}}',)], "raw string")
    got = flatten_variant_pages(landed(parse_pages(texts)))
    expected = flatten_pages(texts.select(F.from_json("raw", PAGE).alias("p")).select("p.*"))
    assert got.columns == expected.columns
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)


def test_variant_quarantine_and_other_types(spark):
    rows = [(GOOD,), ("",), ("  ",), (None,), ("{broken",), ("[1, 2]",), ('{"tracks":{"items":{"uri":"x"}}}',),
            ('{"total":7,"tracks":{"items":[{"uri":5,"rating":"x","album":{"total_tracks":"many"}},{"rating":2,"artists":"none"}]}}',)]
    parsed = parse_pages(spark.createDataFrame(rows, "raw string"))
    bad = sorted(map(tuple, quarantined(parsed).collect()), key=str)
    assert bad == sorted([("", "empty"), ("  ", "empty"), (None, "empty"), ("{broken", "not JSON"), ("[1, 2]", "no items"),
                          ('{"tracks":{"items":{"uri":"x"}}}', "no items")], key=str)
    got = flatten_variant_pages(landed(parsed), {"total": ("$.total", "int")}, {"rating": ("$.rating", "int")})
    rows = sorted(((r.uri, r.album_num_tracks, r.artist_id, r.total, r.rating) for r in got.collect()), key=str)
    assert rows == sorted([("u1", 3, "1", None, None), ("u2", None, None, None, None), ("5", None, None, 7, None), (None, None, None, 7, 2)], key=str)
    none = parse_pages(spark.createDataFrame([], "raw string"))
    assert flatten_variant_pages(landed(none)).collect() == [] and quarantined(none).collect() == []


def loads(spark):
    def load(rows):
        return spark.createDataFrame([(k, k % 3, v, datetime.datetime(2024, m, 1)) for k, v, m in rows], "id int, part int, v string, updated_at timestamp_ntz")

    return [load([(k, f"a{k}", 1) for k in range(200)]),
            load([(k, f"b{k}", 2 if k % 4 == 0 else 1) for k in range(50, 260)]),
            load([(k, f"c{k}", 3 if k % 5 == 0 else 1) for k in range(120)])]


AS_OF = ["2024-01-02 00:00:00", "2024-02-02 00:00:00", "2024-03-02"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stored_history_equals_snapshots(spark):
    history = StoredHistory(spark, scratch_path(spark, "history's"), ["id", "part"], "updated_at", buckets=4)
    expected = None
    for load, as_of in zip(loads(spark), AS_OF):
        expected = scd2_snapshot(expected, load, ["id", "part"], "updated_at", as_of)
        number = history.run(load, as_of)
        assert history.run(load, as_of) == number  # the same label again changes nothing
        assert rows(history.snapshot()) == rows(expected)
    open_folder = history._state()["open"]
    assert len(history._state()["closed"]) == 2 and history.compact() == 4 and len(history._state()["closed"]) == 1
    assert history._state()["open"] == open_folder and history.compact() == 4
    assert rows(history.snapshot()) == rows(expected)
    # a session whose catalog does not know the files yet
    spark.sql(f"DROP TABLE {history._name(open_folder)}")
    again = StoredHistory(spark, history.root, ["id", "part"], "updated_at")
    assert again.buckets == 4 and rows(again.snapshot()) == rows(expected)
    again.run(loads(spark)[1].withColumn("id", F.col("id").cast("long")), "2024-04-02")  # keys of another type find their rows
    assert rows(again.snapshot()) == rows(scd2_snapshot(expected, loads(spark)[1], ["id", "part"], "updated_at", "2024-04-02"))


def test_stored_history_shuffles_no_open_row(spark):
    history = StoredHistory(spark, scratch_path(spark, "history"), ["id", "part"], "updated_at", buckets=4)
    first, second, _ = loads(spark)
    history.run(first, AS_OF[0])
    source = history._read(history._store(second.repartition(4, "id", "part"), "source"), second.schema)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a source that is not small
    try:
        plans = [part._jdf.queryExecution().executedPlan().toString() for part in history.step(source, AS_OF[1])]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert all("Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan for plan in plans)


def test_stored_history_conflict_and_repeated_keys(spark):
    root = scratch_path(spark, "history")
    history = StoredHistory(spark, root, ["id", "part"], "updated_at", buckets=4)
    first, second, third = loads(spark)
    with pytest.raises(ValueError):
        history.run(first.union(first), AS_OF[0])
    history.run(first.limit(0), "2023-12-01")
    assert history.snapshot().collect() == []
    state = history._state
    stale = state()
    history.run(first, AS_OF[0])
    before = rows(history.snapshot())
    history._state = lambda: stale  # a writer that began before that run
    with pytest.raises(Conflict):
        history.run(second, AS_OF[1])
    history._state = state
    assert rows(history.snapshot()) == before
