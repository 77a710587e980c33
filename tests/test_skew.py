"""Hot keys: one key holds a third of all rows. Results must stay whole and exact."""
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from chartmart.operators.dedup import latest_per_key, purge_duplicated_keys
from chartmart.operators.keys import assign_surrogate_keys
from chartmart.operators.quality import check_unique
from conftest import rows

N = 3000


def skewed(spark):
    data = []
    for i in range(N):
        uri = "hot" if i % 3 == 0 else f"u{i % 400}"
        data.append((uri, i % 5, (i * 7) % 11))
    return data, spark.createDataFrame(data, "uri string, rank bigint, streams bigint").repartition(6)


def test_purge_hot_key(spark):
    data, df = skewed(spark)
    cnt = Counter((u, s) for u, _, s in data)
    bad = {u for (u, s), n in cnt.items() if n > 1}
    expect = sorted([r for r in data if r[0] not in bad], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(purge_duplicated_keys(df, ["uri"], ["uri", "streams"])) == expect


def test_latest_per_key_hot_key(spark):
    data, df = skewed(spark)
    pdf = pd.DataFrame(data, columns=["uri", "rank", "streams"])
    best = pdf.sort_values(["rank", "streams"], ascending=False).groupby("uri").head(1)
    got = rows(latest_per_key(df, ["uri"], ["rank", "streams"]))
    assert got == sorted(map(tuple, best.itertuples(index=False)), key=lambda t: tuple(str(x) for x in t))


def test_keys_on_repeated_values_spread(spark):
    _, df = skewed(spark)
    keyed = assign_surrogate_keys(df.select("uri"), ["uri"], "k", num_partitions=6, tiebreak=True)
    ks = [r[0] for r in keyed.select("k").collect()]
    assert sorted(ks) == list(range(1, N + 1))
    hot = keyed.filter(F.col("uri") == "hot").agg(F.min("k"), F.max("k")).first()
    assert hot[1] - hot[0] + 1 == N // 3  # the hot value's keys are one dense run
    # with the random tiebreak, range partitioning splits the hot value over several tasks
    ranged = df.select("uri").withColumn("_tie", F.rand(17)).repartitionByRange(6, "uri", "_tie")
    hot_parts = ranged.filter(F.col("uri") == "hot").select(F.spark_partition_id()).distinct().count()
    plain = df.select("uri").repartitionByRange(6, "uri")
    assert plain.filter(F.col("uri") == "hot").select(F.spark_partition_id()).distinct().count() == 1
    assert hot_parts > 1


def test_unique_check_hot_value(spark):
    _, df = skewed(spark)
    assert rows(check_unique(df, "uri").filter("unique_field = 'hot'")) == [("hot", N // 3)]


def test_salted_lookup_equals_plain(spark):
    from chartmart.operators.fact import Lookup, star_lookup

    data, df = skewed(spark)
    dim = spark.createDataFrame([(1, "hot"), (2, "hot"), (3, "u1"), (4, "u2")], "k bigint, nat string")
    plain = star_lookup(df, [Lookup(dim, "uri", "nat", "k")])
    salted = star_lookup(df, [Lookup(dim, "uri", "nat", "k", salt=8)])
    assert rows(salted) == rows(plain)
    assert plain.count() == N + N // 3 + 0  # hot rows fan out over two dimension rows
