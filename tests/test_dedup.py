from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartmart.operators.dedup import drop_exact_duplicates, flag_duplicates, latest_per_key, purge_duplicated_keys
from conftest import rows

SCHEMA = "uri string, rank bigint, streams bigint"


def purge(df):
    return purge_duplicated_keys(df, ["uri"], ["uri", "streams"])


def test_purge_deletes_every_row_of_a_repeated_key(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("a", 3, 99), ("b", 1, 5)], SCHEMA)
    # the two 'a' rows differing only in rank count as duplicates; the third 'a' row goes too
    assert rows(purge(df)) == [("b", 1, 5)]


def test_keep_one_keeps_one_copy(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 10), ("a", 3, 99)], SCHEMA)
    assert rows(drop_exact_duplicates(df)) == [("a", 1, 10), ("a", 3, 99)]


def test_null_key_duplicates_survive_purge(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 1, 10), ("c", 1, 1)], SCHEMA)
    assert rows(purge(df)) == [("c", 1, 1), (None, 1, 10), (None, 1, 10)]


def test_tuple_key_with_null_part_survives(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (2, 2, 7), (2, 2, 7)], "k1 bigint, k2 bigint, v bigint")
    out = purge_duplicated_keys(df, ["k1", "k2"], ["k1", "k2", "v"])
    assert rows(out) == [(1, None, 5), (1, None, 5)]


def test_flag_duplicates_counts_surplus_copies(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("a", 3, 10), ("b", 1, 5)], SCHEMA)
    assert rows(flag_duplicates(df, ["uri", "streams"], ["uri"])) == [("a", 2)]


def test_latest_per_key_desc_nulls_last(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, None, "y"), (1, 7, "z"), (2, None, "w")], "k bigint, t bigint, p string")
    assert rows(latest_per_key(df, ["k"], ["t"])) == [(1, 7, "z"), (2, None, "w")]
    win = latest_per_key(df, ["k"], [F.col("t").desc_nulls_last()])
    assert rows(win) == [(1, 7, "z"), (2, None, "w")]


def test_keep_one_with_order_picks_smallest(spark):
    df = spark.createDataFrame([(3, "t"), (1, "t"), (2, "u")], "id bigint, text string")
    assert rows(drop_exact_duplicates(df, ["text"], order=["id"])) == [(1, "t"), (2, "u")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.integers(0, 2)),
                min_size=0, max_size=25))
def test_purge_property_partition_of_input(spark, data):
    df = spark.createDataFrame(data, SCHEMA) if data else spark.createDataFrame([], SCHEMA)
    kept = rows(purge(df))
    # brute force: keys with any repeated (uri, streams) group, NULL key never deleted
    from collections import Counter
    cnt = Counter((u, s) for u, _, s in data)
    bad = {u for (u, s), n in cnt.items() if n > 1 and u is not None}
    expect = sorted([r for r in data if r[0] not in bad], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert kept == expect


def test_purge_is_the_same_whatever_the_planner_joins_with(spark):
    """Whether the key set is broadcast is the planner's choice from its bytes: same rows either way."""
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("b", 1, 5), (None, 1, 1), (None, 2, 1)], SCHEMA)
    small = rows(purge(df))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = purge(df)
        assert rows(big) == small == [("b", 1, 5), (None, 1, 1), (None, 2, 1)]
        assert "BroadcastHashJoin" not in big._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_purge_shuffles_no_wide_row(spark):
    """With few repeated keys, the columns that are not compared never pass an exchange."""
    from chartmart.session import stage

    df = stage(spark.range(2000).select(F.concat(F.lit("u"), F.col("id") % 1990).alias("uri"), (F.col("id") % 7).alias("rank"),
                                        F.lit(1).cast("bigint").alias("streams"), F.repeat(F.lit("x"), 500).alias("payload")), "wide")
    plan = purge_duplicated_keys(df, ["uri"], ["uri", "streams"])
    assert plan.count() == 1980
    text = plan._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in text and "payload" in text


def test_keep_one_text_equals_exact(spark):
    import os

    from chartmart.operators.dedup import first_per_key
    from conftest import SF_SMALL

    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet"))
    extra = spark.createDataFrame([(10**9, None, "x", "s", 0), (10**9 + 1, None, "y", "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    exact = first_per_key(docs, ["text"], ["doc_id"], descending=False)
    hashed = drop_exact_duplicates(docs, ["text"], order=["doc_id"])
    assert rows(hashed) == rows(exact)
    assert hashed.count() == docs.select("text").distinct().count()


def test_purge_does_not_shuffle_wide_rows_for_few_keys(spark):
    from pyspark.sql import functions as F

    from chartmart.operators.dedup import purge_duplicated_keys

    rows = spark.range(300).select((F.col("id") % 290).alias("k"), F.lit("wide").alias("v"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the planner saw too many keys for its own limit
    try:
        out = purge_duplicated_keys(rows, ["k"], ["k", "v"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(r.k for r in out.collect()) == list(range(10, 290))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_whole_averages_are_exact(spark):
    from pyspark.sql import functions as F

    from chartmart.operators.marts import _avg

    values = [2**63 - 1, -(2**63), 2**63 - 1, -5, 7, None]
    rows = spark.createDataFrame([(k % 2, v) for k, v in enumerate(values * 3)] + [(2, None)], "g int, v long")
    got = rows.groupBy("g").agg(_avg("v", 6, True).alias("a"), _avg("v", 6).alias("b")).collect()
    assert len(got) == 3 and all(r.a == r.b for r in got)
    plan = rows.groupBy("g").agg(_avg("v", 6, True).alias("a"))._jdf.queryExecution().optimizedPlan().toString()
    assert "avg(" not in plan
