"""Incremental marts, compiled checks and the lookup of heavy keys."""

import random
import uuid
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chartmart.operators.compiled_checks import Check, CheckFailed, enforce, run_compiled, run_table_checks
from chartmart.operators.fact import Lookup, heavy_keys, star_lookup
from chartmart.operators.incremental_marts import ARTIST, IncrementalMart
from chartmart.operators.marts import artist_streams
from chartmart.operators.quality import check_not_null, check_result, check_unique
from chartmart.schemas import FACT_COLUMNS
from chartmart.sources.commits import CommittedTable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, seed, n, keys=12):
    rnd = random.Random(seed)
    some = lambda *v: rnd.choice([None, *v])
    data = [(rnd.randrange(9), some(*range(keys)), 1, 1, some(*range(50)), 1, 1, 1, some(*range(1000)), some(0.1, 0.2, 1 / 3)) for _ in range(n)]
    types = "track_key long, artist_key long, country_key long, date_key long, rank long, peak_rank long, previous_rank long, weeks_on_chart long, streams long, popularity_score double"
    return spark.createDataFrame(data, types).select(*FACT_COLUMNS)


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_mart_equals_recomputation(spark, tmp_path, seed):
    mart = IncrementalMart(CommittedTable(spark, f"file://{tmp_path}/{uuid.uuid4().hex}"), ["artist_key"], ARTIST, buckets=4)
    have = {}
    steps = [("a", facts(spark, seed, 60)), ("b", facts(spark, seed + 9, 40, 30)), ("a", facts(spark, seed + 1, 50, 5)), ("b", facts(spark, 1, 0)), ("c", facts(spark, 5, 3))]
    for k, (part, own) in enumerate(steps):
        have[part] = own
        mart.load(part, own, run=f"run {k}")
        assert mart.load(part, own, run=f"run {k}").number == k + 1
        whole = None
        for x in have.values():
            whole = x if whole is None else whole.unionByName(x)
        assert rows(mart.read(6)) == rows(artist_streams(whole, 6))
    raw = {r[0]: r for r in mart.read().collect()}
    for r in artist_streams(whole).collect():
        assert raw[r[0]][1:] == pytest.approx(r[1:])


def test_incremental_mart_touches_few_buckets(spark, tmp_path):
    mart = IncrementalMart(CommittedTable(spark, f"file://{tmp_path}/{uuid.uuid4().hex}"), ["artist_key"], ARTIST, buckets=8)
    before = mart.load("all", facts(spark, 3, 200, 60))
    after = mart.load("one", facts(spark, 4, 20, 1).where("artist_key = 0"))
    changed = [b for b in after.parts["totals"] if after.parts["totals"][b] != before.parts["totals"].get(b)]
    assert len(changed) == 1 and after.parts["partials"]["all"] == before.parts["partials"]["all"]


def test_compiled_checks_equal_single_ones_in_one_scan(spark, tmp_path):
    data = [(1, "a", 1.0, None), (2, "a", -0.0, None), (None, "b", 0.0, None), (None, None, float("nan"), None), (3, None, float("nan"), None)]
    spark.createDataFrame(data, "k long, s string, d double, z string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    checks = [Check(kind, c, f"{kind}_{c}") for c in "ksdz" for kind in ("not_null", "unique")] + [Check("type", "k", "t1", "number"), Check("type", "s", "t2", "number")]
    got = run_table_checks(df, checks)
    assert plan(got).count("Scan parquet") == 1
    want = [tuple(check_result((check_not_null if c.kind == "not_null" else check_unique)(df, c.column), c.name).first()) for c in checks[:-2]]
    assert rows(got) == sorted([*want, ("t1", 0, False, False), ("t2", 1, True, True)])
    none = run_table_checks(df.where("k > 9"), checks)
    assert [r.failures for r in none.collect()] == [0] * 9 + [1]


def test_failed_checks_stop_or_warn(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    report = lambda a, b: run_compiled([(df, [Check("unique", "k", "u", severity=a)]), (df, [Check("not_null", "k", "n", severity=b), Check("type", "k", "t", "number")])])
    assert enforce(report("warn", "warn")) == ["n", "u"]
    with pytest.raises(CheckFailed, match=r"n \(1\)"):
        enforce(report("warn", "error"))
    assert enforce(run_table_checks(df, [Check("type", "k", "t", "number")])) == []
    with pytest.raises(ValueError):
        Check("odd", "k", "x")


def skewed(spark, n=3000):
    data = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"u{i % 400}", i) for i in range(n)]
    return data, spark.createDataFrame(data, "uri string, rank long").repartition(6)


@pytest.mark.parametrize("lookup", ["all", "first"])
def test_heavy_lookup_equals_plain(spark, lookup):
    data, src = skewed(spark)
    dim_rows = [("hot", 1), ("hot", 2), (None, 3)] + [(f"u{k}", 10 + k) for k in range(0, 400, 2)] + [("u4", 900)]
    dim = spark.createDataFrame(dim_rows, "uri string, key long")
    assert heavy_keys(src, "uri", 0.1) == ["hot"] and heavy_keys(src.limit(0), "uri", 0.1) == []
    got = star_lookup(src, [Lookup(dim, "uri", "uri", "key", heavy=0.1)], lookup)
    have = defaultdict(list)
    for u, k in dim_rows:
        have[u].append(k)
    want = [(u, i, k) for u, i in data for k in ((sorted(have[u])[: None if lookup == "all" else 1] if u is not None else []) or [None])]
    assert rows(got) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_heavy_rows_are_spread(spark):
    _, src = skewed(spark)
    dim = spark.createDataFrame([("hot", 1)] + [(f"u{k}", k) for k in range(400)], "uri string, key long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = star_lookup(src, [Lookup(dim, "uri", "uri", "key", heavy=0.1)])
        text = plan(got)
        assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1  # the heavy key's row; the rest
        sizes = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        plain = star_lookup(src, [Lookup(dim, "uri", "uri", "key")]).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) < 0.4 * 3000 < max(r["count"] for r in plain) + 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
