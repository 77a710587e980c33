import os
import tempfile

import pytest

from chartmart.streaming.release_stream import latest_version, parts, stream_dedup, stream_upsert

SCHEMA = "k long, v string"


def land(spark, folder, name, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def folders():
    base = tempfile.mkdtemp(prefix="chartmart-stream-")
    return [os.path.join(base, x) for x in ("in/*", "in", "out", "ck")]


def run(spark, paths, **more):
    src, _, out, ck = paths
    return stream_dedup(spark, src, spark.createDataFrame([], SCHEMA).schema, out, ck, ["k"], max_files=1, **more)


def result(spark, paths):
    return sorted(map(tuple, parts(spark, paths[2], spark.createDataFrame([], SCHEMA).schema).collect()), key=str)


def test_every_key_once_over_batches_and_restarts(spark):
    paths = folders()
    land(spark, paths[1], "a", [(1, "a"), (2, "a"), (None, "a"), (1, "b")])
    run(spark, paths)
    land(spark, paths[1], "b", [(2, "late"), (3, "b"), (None, "late")])
    land(spark, paths[1], "c", [(3, "again"), (0, "very late"), (1, "a")])
    run(spark, paths)  # a restart goes on where the checkpoint stands
    got = result(spark, paths)
    assert [k for k, _ in got] == [0, 1, 2, 3, None] and dict(got)[1] == "a" and dict(got)[2] == "a"
    run(spark, paths)  # nothing new
    assert result(spark, paths) == got


def test_a_retried_batch_rewrites_its_own_part(spark):
    paths = folders()
    land(spark, paths[1], "a", [(1, "a")])
    run(spark, paths)
    land(spark, paths[1], "b", [(1, "x"), (2, "b")])
    run(spark, paths)
    got = result(spark, paths)
    # as if the driver had died after writing the part, before the checkpoint's commit
    os.remove(os.path.join(paths[3], "commits", "1"))
    crc = os.path.join(paths[3], "commits", ".1.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run(spark, paths)
    assert result(spark, paths) == got == [(1, "a"), (2, "b")]


def test_an_unfinished_part_is_not_read(spark):
    paths = folders()
    land(spark, paths[1], "a", [(1, "a")])
    run(spark, paths)
    os.makedirs(os.path.join(paths[2], "batch=7"))
    with open(os.path.join(paths[2], "batch=7", "part-0.parquet"), "wb") as f:
        f.write(b"half")
    assert result(spark, paths) == [(1, "a")]


def test_running_query_is_returned(spark):
    paths = folders()
    land(spark, paths[1], "a", [(1, "a")])
    q = run(spark, paths, available_now=False)
    try:
        assert q.isActive
    finally:
        q.stop()


def test_upsert_over_batches_restart_and_failed_version(spark):
    src, folder, versions, ck = folders()
    initial = spark.createDataFrame([(1, "old"), (9, "old")], SCHEMA)
    schema = initial.schema
    fail = {"on": False}

    def apply(dim, batch):
        if fail["on"]:
            raise RuntimeError("the write fails")
        return dim.join(batch.select("k"), "k", "left_anti").unionByName(batch)

    def go():
        return stream_upsert(spark, src, schema, versions, ck, initial, apply, max_files=1)

    land(spark, folder, "a", [(1, "new")])
    latest = go()
    assert sorted(map(tuple, spark.read.parquet(latest).collect())) == [(1, "new"), (9, "old")]
    land(spark, folder, "b", [(2, "b")])
    fail["on"] = True
    with pytest.raises(Exception):
        go()
    assert latest_version(spark, versions) == latest  # nothing was published, nothing lost
    fail["on"] = False
    latest = go()
    assert sorted(map(tuple, spark.read.parquet(latest).collect())) == [(1, "new"), (2, "b"), (9, "old")]
