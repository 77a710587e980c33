"""Committed tables, sequences, merges and purges by bucket."""

import random
import threading
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chartmart.operators.bucketed import PurgeIndex, bucket_of, merge_into, store_dimension
from chartmart.operators.dedup import purge_duplicated_keys
from chartmart.operators.keys import assign_from_sequence
from chartmart.operators.upsert import merge_upsert, src
from chartmart.sources.commits import NOTHING, CommittedTable, Conflict, Sequence, Version


def table(spark, tmp_path):
    return CommittedTable(spark, f"file://{tmp_path}/{uuid.uuid4().hex}")


def numbers(spark, a, b):
    return spark.range(a, b).withColumn("x", F.col("id") * 2)


def test_versions(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.latest() == NOTHING
    with pytest.raises(FileNotFoundError):
        t.read()
    v = t.replace(numbers(spark, 0, 10))
    assert (v.number, v.rows, v.operation) == (1, 10, "replace")
    t.append(numbers(spark, 10, 12).select("x", "id"))
    assert rows(t.read()) == rows(numbers(spark, 0, 12)) and rows(t.read(1)) == rows(numbers(spark, 0, 10))
    with pytest.raises(ValueError):
        t.append(spark.range(3))
    t.replace(numbers(spark, 50, 51), run="day")
    assert t.committed("day").number == 3 and t.committed("other") is None
    t.rollback(2)
    assert [v.operation for v in t.history()] == ["replace", "append", "replace", "rollback"]
    assert rows(t.read()) == rows(numbers(spark, 0, 12))


def test_reload_that_dies_leaves_the_old_rows(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(numbers(spark, 0, 10))
    broken = spark.range(0, 1000, 1, 8).withColumn("x", F.when(F.col("id") == 900, F.raise_error(F.lit("bad row")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="bad row"):
        t.replace(broken)
    assert t.latest().number == 1 and rows(t.read()) == rows(numbers(spark, 0, 10))
    # a death between the files and the commit
    t.write(numbers(spark, 20, 30))
    assert rows(t.read()) == rows(numbers(spark, 0, 10))


def test_two_writers_from_one_version(spark, tmp_path):
    t = table(spark, tmp_path)
    base = t.replace(numbers(spark, 0, 10))
    t.replace(numbers(spark, 10, 20), base=base)
    with pytest.raises(Conflict):
        t.replace(numbers(spark, 20, 30), base=base)
    assert rows(t.read()) == rows(numbers(spark, 10, 20))


def test_appends_at_once_all_stay(spark, tmp_path):
    t, s = table(spark, tmp_path), Sequence(spark, f"file://{tmp_path}/sequence", start=5)
    t.replace(numbers(spark, 0, 1))
    firsts = []

    def add(k):
        firsts.append((s.take(k), k))
        t.append(numbers(spark, 10 * k, 10 * k + k))

    threads = [threading.Thread(target=add, args=(k,)) for k in range(1, 7)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert t.latest().number == 7 and t.read().count() == 1 + 21
    given = [n for first, k in firsts for n in range(first, first + k)]
    assert sorted(given) == list(range(5, 5 + 21)) and s.take(0) == s.take(1) == 26


def test_a_taken_number_is_never_given_again(spark, tmp_path):
    log = table(spark, tmp_path).log
    log.put(1, {"a": 1})
    with pytest.raises(Conflict):
        log.put(1, {"a": 2})
    assert log.get(1) == {"a": 1} and log.children(log.folder) == ["000000000001.json"]


def test_buckets_and_empty_rows(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(numbers(spark, 0, 100), bucket=bucket_of(["id"], 7))
    assert len(t.latest().parts[""]) == 7 and rows(t.read()) == rows(numbers(spark, 0, 100))
    some = t.read(buckets=[2, 99])
    assert rows(some) == rows(numbers(spark, 0, 100).where(bucket_of(["id"], 7) == 2))
    t.replace(numbers(spark, 0, 0), bucket=bucket_of(["id"], 7))
    assert t.read().collect() == [] and t.read().columns == ["id", "x"]
    t.replace(numbers(spark, 0, 0))
    assert t.read().collect() == []


def artists(spark, given):
    return spark.createDataFrame(given, "k long, id string, genre string, name string, start int")


def test_sequence_keys(spark, tmp_path):
    s = Sequence(spark, f"file://{tmp_path}/keys")
    one = assign_from_sequence(spark.range(5).select(F.col("id").alias("v")), ["v"], "k", s)
    two = assign_from_sequence(spark.range(3).select((F.col("id") + 50).alias("v")), ["v"], "k", s)
    assert rows(two) == [(6, 50), (7, 51), (8, 52)] and rows(one) == [(k + 1, k) for k in range(5)]
    assert assign_from_sequence(spark.range(0).select(F.col("id").alias("v")), ["v"], "k", s).collect() == [] and s.take(1) == 9


@pytest.mark.parametrize("on_stale", ["skip", "insert"])
def test_merge_by_bucket_equals_merge(spark, tmp_path, on_stale):
    rnd = random.Random(3)
    dim = [(k + 1, f"a{k}" if k % 9 else None, f"g{k % 4}" if k % 7 else None, f"n{k}", rnd.choice([None, 1, 5])) for k in range(60)]
    how = {"on": [("id", "sid"), ("genre", "sgenre")], "fresher": ("start", "load"), "set_": {"name": src("sname"), "start": F.lit(9)},
           "insert": {"id": src("sid"), "genre": src("sgenre"), "name": src("sname"), "start": F.lit(None).cast("int")}, "key": "k", "insert_order": ["id", "genre", "name"]}
    t, s = table(spark, tmp_path), Sequence(spark, f"file://{tmp_path}/{uuid.uuid4().hex}", start=61)
    plain = artists(spark, dim)
    store_dimension(t, plain, ["id", "genre"], n=12)
    for day in range(3):
        source = [(f"a{day * 20 + k * 3}" if k else None, f"g{(day * 20 + k * 3) % 4}", f"new{day}", 3) for k in range(8)]
        source += [(f"z{day}", "g1", "brand new", 3), (f"y{day}", None, "no genre", 3)]
        frame = spark.createDataFrame(source, "sid string, sgenre string, sname string, load int")
        before = t.latest()
        after = merge_into(t, frame, sequence=s, on_stale=on_stale, run=f"day {day}", **how)
        plain = spark.createDataFrame(merge_upsert(plain, frame, on_stale=on_stale, **how).collect(), plain.schema)
        assert rows(t.read()) == rows(plain)
        hit = {str(r[0]) for r in frame.select(bucket_of(["sid", "sgenre"], 12)).distinct().collect()}
        assert len(hit) < 12 and {b: f for b, f in after.parts[""].items() if b not in hit} == {b: f for b, f in before.parts[""].items() if b not in hit}
        assert merge_into(t, frame, sequence=s, on_stale=on_stale, run=f"day {day}", **how).number == after.number  # run again
    assert merge_into(t, frame.limit(0), sequence=s, **how).number == t.latest().number


def test_merge_conflict_leaves_the_first(spark, tmp_path, monkeypatch):
    t, s = table(spark, tmp_path), Sequence(spark, f"file://{tmp_path}/{uuid.uuid4().hex}", start=2)
    store_dimension(t, artists(spark, [(1, "a", "g", "n", 1)]), ["id"], n=4)
    how = {"on": [("id", "sid")], "set_": {"name": src("sname")}, "insert": {"id": src("sid"), "name": src("sname")}, "key": "k"}
    stale: Version = t.latest()
    merge_into(t, spark.createDataFrame([("a", "first")], "sid string, sname string"), sequence=s, **how)
    monkeypatch.setattr(t, "latest", lambda: stale)
    with pytest.raises(Conflict):
        merge_into(t, spark.createDataFrame([("a", "second")], "sid string, sname string"), sequence=s, **how)
    monkeypatch.undo()
    assert [r.name for r in t.read().collect()] == ["first"]
    with pytest.raises(ValueError):
        merge_into(t, spark.createDataFrame([("a", "g")], "sid string, g string"), sequence=s, on=[("genre", "g")], set_={}, insert={}, key="k")


@pytest.mark.parametrize("seed", [1, 2])
def test_purge_over_loads_equals_one_purge(spark, tmp_path, seed):
    rnd = random.Random(seed)
    draw = lambda: (rnd.choice([None, *(f"k{i}" for i in range(60))]), rnd.choice([None, "", "a", "b"]), rnd.choice([None, 1, 2]), rnd.random())
    loads = [[draw() for _ in range(n)] for n in (40, 0, 50, 30)] + [[("hot", "a", 1, 0.5)] * 100]
    schema = "k string, a string, b int, other double"
    index = PurgeIndex(table(spark, tmp_path), ["k"], ["a", "b"], buckets=8)
    seen = []
    for n, load in enumerate(loads):
        seen += load
        before = index.table.latest()
        after = index.load(spark.createDataFrame(load, schema), run=f"load {n}")
        assert rows(index.rows()) == rows(purge_duplicated_keys(spark.createDataFrame(seen, schema), ["k"], ["a", "b"]))
        assert index.load(spark.createDataFrame(load, schema), run=f"load {n}").number == after.number
    # the last load held one key only: of its bucket and fingerprint alone anything was written anew
    for family in ("rows", "prints", "dead"):
        changed = [b for b in before.parts[family] if before.parts[family][b] != after.parts[family].get(b)]
        assert len(changed) <= 1, family


def test_purge_of_two_key_columns(spark, tmp_path):
    index = PurgeIndex(table(spark, tmp_path), ["k", "m"], ["k", "m", "a"], buckets=4)
    given = [("x", 1, "p"), ("x", 2, "p"), (None, 1, "p"), (None, 1, "p"), ("y", None, "q")]
    schema = "k string, m int, a string"
    for load in (given, [("x", 1, "p")], [("y", None, "q"), ("x", 1, "z"), ("x", 2, "w")]):
        index.load(spark.createDataFrame(load, schema))
    whole = spark.createDataFrame(given + [("x", 1, "p"), ("y", None, "q"), ("x", 1, "z"), ("x", 2, "w")], schema)
    assert rows(index.rows()) == rows(purge_duplicated_keys(whole, ["k", "m"], ["k", "m", "a"]))
