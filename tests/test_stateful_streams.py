"""State-store dedup with its late side, and merges of micro-batches by bucket."""

import datetime as dt
import random
import uuid

from conftest import rows
from pyspark.sql import functions as F

from chartmart.operators.bucketed import merge_into, store_dimension
from chartmart.operators.upsert import src
from chartmart.sources.commits import CommittedTable, Sequence
from chartmart.streaming.stateful import kept, late, stream_dedup_within, stream_merge

SCHEMA = "k long, ts timestamp, v string"
START = dt.datetime(2024, 1, 1)


class Feed:
    def __init__(self, spark, tmp_path, delay):
        base = f"{tmp_path}/{uuid.uuid4().hex}"
        self.spark, self.delay, self.src, self.out, self.ck = spark, delay, f"{base}/in", f"{base}/out", f"{base}/ck"
        self.schema = spark.createDataFrame([], SCHEMA).schema
        self.dropped = 0

    def add(self, data):
        frame = self.spark.createDataFrame([(k, None if s is None else START + dt.timedelta(seconds=s), v) for k, s, v in data], SCHEMA)
        frame.repartition(3).write.mode("append").parquet(self.src)
        q = stream_dedup_within(self.spark, self.src, self.schema, self.out, self.ck, ["k"], "ts", self.delay)
        self.dropped += sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])

    def sides(self):
        name = lambda df: sorted((r.k, r.v) for r in df.collect())
        return name(kept(self.spark, self.out, self.schema)), name(late(self.spark, self.out, self.schema))


def test_nothing_late_equals_distinct_over_restarts(spark, tmp_path):
    rnd = random.Random(1)
    feed = Feed(spark, tmp_path, "1 day")
    given = [[(rnd.randrange(30), rnd.randrange(3600), "x") for _ in range(40)] for _ in range(3)]
    for data in given:
        feed.add(data)  # every one is a new start from the checkpoint
    got, gone = feed.sides()
    assert [k for k, _ in got] == sorted({k for data in given for k, _, _ in data}) and gone == [] and feed.dropped == 0


def test_late_rows_are_listed_exactly(spark, tmp_path):
    feed = Feed(spark, tmp_path, "100 seconds")
    feed.add([(1, 10, "a"), (2, 500, "a")])  # the watermark comes to 400
    feed.add([(3, 399, "late"), (4, 400, "late"), (5, 401, "b"), (2, 450, "again"), (6, None, "no time"), (7, 900, "b")])  # to 800
    feed.add([(8, 790, "late"), (9, 801, "c"), (7, 801, "again")])
    got, gone = feed.sides()
    assert got == [(1, "a"), (2, "a"), (5, "b"), (7, "b"), (9, "c")]
    assert gone == [(3, "late"), (4, "late"), (6, "no time"), (8, "late")] and feed.dropped == 3
    feed.add([(3, 2000, "new"), (1, 2001, "forgotten")])
    assert (1, "forgotten") in feed.sides()[0] and (3, "new") in feed.sides()[0]


def test_stream_merge(spark, tmp_path):
    base = f"file://{tmp_path}/{uuid.uuid4().hex}"
    table, keys = CommittedTable(spark, f"{base}/dim"), Sequence(spark, f"{base}/keys", start=3)
    store_dimension(table, spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "k long, id string, name string"), ["id"], n=4)
    how = {"on": [("id", "sid")], "set_": {"name": src("name")}, "insert": {"id": src("sid"), "name": src("name")}, "key": "k"}
    schema = spark.createDataFrame([], "sid string, name string").schema

    def go():
        stream_merge(spark, f"{base}/in", schema, table, f"{base}/ck", lambda batch, run: merge_into(table, batch, sequence=keys, run=run, **how))

    for data in ([("a", "new"), ("c", "new")], [("c", "newer"), ("d", "new")]):
        spark.createDataFrame(data, schema).write.mode("append").parquet(f"{base}/in")
        go()
    want = [(1, "a", "new"), (2, "b", "x"), (3, "c", "newer"), (4, "d", "new")]
    assert rows(table.read()) == want and table.latest().number == 3
    go()  # nothing new
    assert table.latest().number == 3 and [r.name for r in table.read(2).where(F.col("id") == "c").collect()] == ["new"]
