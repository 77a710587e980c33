"""What a run leaves on disk while it goes on: landed files, shuffles of writes that are over, staged keys."""
import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmart import session
from chartmart.operators import bucketed, dedup, fact
from chartmart.plans import registry as R
from chartmart.schemas import RAW_CHART
from chartmart.session import stage
from chartmart.sources import binding as B
from chartmart.sources.commits import CommittedTable
from chartmart.sources.files import FileFormat, scan_csv, write_csv
from conftest import SF_SMALL, rows

TWO = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b")])


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def settled(spark, before):
    for _ in range(50):  # they are removed in the background
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_landed_files_are_compressed_and_short(spark, tmp_path):
    df = spark.range(2500).select(F.col("id").cast("string").alias("a"), F.lit(' x, "y" ').alias("b")).coalesce(1)
    path = str(tmp_path / "landed")
    write_csv(df, path, FileFormat(file_rows=1000))
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)  # a gzip file is one task's
    back = scan_csv(spark, path, TWO)
    assert rows(back) == rows(df)
    plain = str(tmp_path / "plain")
    write_csv(df, plain, FileFormat(compression="none"))
    size = lambda p: sum(os.path.getsize(os.path.join(p, f)) for f in os.listdir(p))
    assert size(path) < size(plain) / 2
    assert rows(scan_csv(spark, plain, TWO)) == rows(df)


def test_shuffles_of_a_write_go_with_it(spark, tmp_path):
    setting = spark.conf.get(session._FREE)
    counted = spark.range(10_000).groupBy((F.col("id") % 100).alias("a")).agg(F.count("*").alias("b"))
    before = shuffle_files(spark)
    kept = stage(counted, "counted")
    write_csv(counted, str(tmp_path / "counted"))
    assert settled(spark, before)
    assert spark.conf.get(session._FREE) == setting
    assert kept.count() == 100 and rows(counted) == rows(kept)


def test_writes_in_threads_put_the_setting_back(spark):
    setting = spark.conf.get(session._FREE)
    one, two = session.shuffles_freed(spark), session.shuffles_freed(spark)
    one.__enter__(), two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(session._FREE) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(session._FREE) == setting


def test_a_purge_in_slices_is_one_purge(spark, monkeypatch):
    fact = spark.range(4000).select((F.col("id") % 700).alias("k1"), F.when(F.col("id") % 50 != 0, F.col("id") % 3).alias("k2"),
                                    F.when(F.col("id") % 7 == 0, 0).otherwise(F.col("id")).alias("v"))
    staged, stage_ = {}, session.stage
    monkeypatch.setattr(session, "stage", lambda df, name, *a: staged.setdefault(name, []).append(stage_(df, name, *a)) or staged[name][-1])
    want = rows(dedup.purge_duplicated_keys(stage_(fact, "fact"), ["k1", "k2"], ["k1", "k2", "v"]))
    assert 0 < len(want) < 4000
    staged.clear()
    for limit in (dedup.MOST_BROADCAST, 5):  # key sets that are broadcast, and that are too large for it
        monkeypatch.setattr(dedup, "MOST_BROADCAST", limit)
        assert rows(dedup.purge_in_slices(fact, ["k1", "k2"], ["k1", "k2", "v"], "fact_rows", slice_rows=1500)) == want
    assert len(staged["fact_rows"]) == 2 and staged["fact_rows"][0].columns == fact.columns  # stored once, without hashes
    sizes = [d.count() for d in staged["repeated_hashes"]]
    assert len(sizes) == 6 and min(sizes) > 0  # three slices each


def test_a_large_key_set_does_not_shuffle_all_rows(spark, monkeypatch):
    data = [(i % 90 if i % 11 else None, f"t{i % 4}", float(i)) for i in range(500)] + [(1000 + i, "t0", 0.0) for i in range(500)]
    df = stage(spark.createDataFrame(data, "a bigint, b string, c double"), "wide")
    keys = stage(df.where("a < 60 or a is null").select("a", "b").distinct(), "keys")
    want = {how: rows(dedup.by_keys(df, keys, ["a", "b"], how)) for how in ("left_semi", "left_anti")}
    assert all(want.values()) and sum(map(len, want.values())) == len(data)
    monkeypatch.setattr(dedup, "MOST_BROADCAST", 10)
    monkeypatch.setattr(dedup, "FILTER_BITS", 16)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how, found in want.items():
            got = dedup.by_keys(df, keys, ["a", "b"], how)
            assert rows(got) == found
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan.split("SortMergeJoin", 1)[1]  # what is shuffled has passed the filter
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_the_literal_purge_of_the_fact_stores_it_once(spark, monkeypatch):
    from chartmart.plans import flows

    seen = []
    monkeypatch.setattr(flows, "build_fact", lambda *a: "fact")
    monkeypatch.setattr(flows, "purge_in_slices", lambda *a: seen.append(a) or "purged")
    dims = dict.fromkeys(("dim_track", "dim_artist", "dim_country", "dim_date"))
    assert flows.run_fact(None, dims, purge_early=False) == "purged"
    assert seen[0][0] == "fact" and seen[0][1:3] == (flows.FACT_KEYS, flows.FACT_COLUMNS)


def test_lookups_broadcast_dimensions_of_few_rows(spark):
    src = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "id string, v int")
    dim = stage(spark.createDataFrame([("x", 10), ("x", 11), ("z", 12)], "nat string, key bigint"), "dim")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the planner alone would shuffle
    try:
        for few, join in ((3, "BroadcastHashJoin"), (2, "SortMergeJoin")):
            out = fact.star_lookup(src, [fact.Lookup(dim, "id", "nat", "key", few=few)])
            assert rows(out) == rows(spark.createDataFrame([("x", 1, 10), ("x", 1, 11), ("y", 2, None), (None, 3, None)], "id string, v int, key bigint"))
            assert join in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_stored_load_is_not_copied_and_earlier_loads_are_not_shuffled(spark, tmp_path, monkeypatch):
    staged, plans = [], []
    stage_, write_ = session.stage, CommittedTable.write
    monkeypatch.setattr(bucketed, "stage", lambda df, name, *a: staged.append((name, df.columns)) or stage_(df, name, *a))
    monkeypatch.setattr(CommittedTable, "write", lambda self, df, family="", *a, **b: plans.append((family, b)) or write_(self, df, family, *a, **b))
    table = CommittedTable(spark, f"file://{tmp_path}/table")
    index = bucketed.PurgeIndex(table, ["k"], ["a"], buckets=4, slice_rows=20)
    loads = [[(i, i % 5) for i in range(40)], [(i, i % 5) for i in range(30, 60)], [(7, 2), (None, 1), (None, 1), (99, 0)]]
    seen, entries = [], 0
    for load in loads:
        seen += load
        df = stage_(spark.createDataFrame(load, "k bigint, a bigint"), "given")
        index.load(df, stored=True)
        entries += df.distinct().count()
        assert rows(index.rows()) == rows(dedup.purge_duplicated_keys(spark.createDataFrame(seen, "k bigint, a bigint"), ["k"], ["a"]))
        # fingerprints of earlier loads stay where they are, those of this one are added; they count together
        assert table.read(None, "prints").count() == entries
    assert table.read(None, "prints").agg(F.sum("_n")).first()[0] == len(seen)
    assert {name for name, _ in staged} == {"repeated", "dying"}  # neither the rows nor all fingerprints are staged
    assert [family for family, b in plans].count("rows") == 2 + 2 + 1 + 2  # buckets of a load in slices, and those purged
    assert [b for family, b in plans if family == "rows" and b] == [{"spread": False}] * 2  # rows purged of loads 1 and 2


def test_rows_read_from_buckets_are_written_without_a_shuffle(spark, tmp_path):
    table = CommittedTable(spark, f"file://{tmp_path}/table")
    df = spark.range(1000).select("id", (F.col("id") * 3).alias("b"))
    bucket = bucketed.bucket_of(["id"], 4)
    first = table.replace(df, bucket=bucket)
    before = shuffle_files(spark)
    written = table.write(table.read(first).where("id % 10 > 0"), bucket=bucket, spread=False)
    assert not shuffle_files(spark) - before
    assert written.rows == 900 and sorted(written.parts) == sorted(first.parts[""])
    assert rows(table.read_written(written)) == rows(df.where("id % 10 > 0"))


def test_the_chart_lands_compressed_and_stays_whole(spark):
    path = R.landed_chart_csv(spark, SF_SMALL)
    assert all(f.endswith(".gz") for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-"))
    raw, back = B.chart_raw(spark, SF_SMALL), scan_csv(spark, path, RAW_CHART)
    # an empty field is NULL when it is read: the one value that a landed file does not tell apart
    told = raw.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in raw.columns])
    assert back.count() == raw.count() and not told.exceptAll(back).count()
