from pyspark.sql import Window
from pyspark.sql import functions as F

from chartmart.operators.keys import assign_surrogate_keys, next_key


def test_keys_dense_and_ordered_nulls_first(spark):
    data = [(f"n{i % 37}", i % 5 if i % 7 else None) for i in range(500)]
    df = spark.createDataFrame(data, "name string, v bigint").distinct()
    out = assign_surrogate_keys(df, ["name", "v"], "k", num_partitions=6)
    expect = df.withColumn("k", F.row_number().over(
        Window.orderBy(F.col("name").asc_nulls_first(), F.col("v").asc_nulls_first())).cast("bigint"))
    got = sorted(tuple(r) for r in out.select("k", "name", "v").collect())
    exp = sorted(tuple(r) for r in expect.select("k", "name", "v").collect())
    assert got == exp
    assert [r[0] for r in got] == list(range(1, df.count() + 1))


def test_keys_continue_from_start(spark):
    df = spark.createDataFrame([("x",), ("y",)], "a string")
    out = assign_surrogate_keys(df, ["a"], "k", start=next_key(spark.createDataFrame([(41,)], "k bigint"), "k"))
    assert sorted(tuple(r) for r in out.collect()) == [(42, "x"), (43, "y")]


def test_keys_plan_has_no_single_partition_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("a")).distinct()
    out = assign_surrogate_keys(df, ["a"], "k", num_partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_keys_plan_does_not_grow_with_partitions(spark):
    def size(n):
        df = spark.range(20000).select((F.col("id") % 9973).alias("a"))
        return len(assign_surrogate_keys(df, ["a"], "k", num_partitions=n)._jdf.queryExecution().optimizedPlan().toString())

    assert abs(size(4) - size(800)) < 200
