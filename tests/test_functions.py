import datetime as dt

from pyspark.sql import functions as F

from chartmart.functions import (collab_flag, first_or_null, infer_country, join_names, released_in_last_days,
                                 safe_ratio, strip_prefix, try_date, try_float, try_int)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_try_int_rounds_and_nulls(spark):
    got = one_col(spark, ["12.7", "12.5", "-12.5", " 7 ", "1e3", "n/a", "", None, "99999999999999999999999"], try_int)
    assert got == [13, 13, -13, 7, 1000, None, None, None, None]


def test_try_float(spark):
    assert one_col(spark, ["0.25", "-3.5", "abc", ""], try_float) == [0.25, -3.5, None, None]


def test_try_date_strict_format(spark):
    got = one_col(spark, ["31-12-2020", "2020-12-31", "1-2-2020", "31-02-2020", "bad-date", None], try_date)
    assert got == [dt.date(2020, 12, 31), None, None, None, None, None]


def test_strip_prefix_literal_position_and_separator(spark):
    vals = ["catalog:artist:42", "catalog:track:abc", None]
    assert one_col(spark, vals, strip_prefix) == ["42", "bc", None]  # 14-char prefix loses one char
    assert one_col(spark, vals, lambda c: strip_prefix(c, sep=":")) == ["42", "abc", None]


def test_safe_ratio_rank_zero(spark):
    df = spark.createDataFrame([(10, 0), (10, 4), (1, 3), (None, 2)], "s bigint, r bigint")
    got = [r[0] for r in df.select(safe_ratio("s", "r")).collect()]
    assert got[0] is None and got[1] == 2.5 and abs(got[2] - 1 / 3) < 1e-15 and got[3] is None


def test_infer_country_first_match_case_sensitive(spark):
    got = one_col(spark, ["US K-pop", "us pop", "K-pop ballad", "", None], infer_country)
    assert got == ["United States", "Global", "South Korea", "Global", "Global"]


def test_collab_flag(spark):
    assert one_col(spark, [1, 2, 3], collab_flag, "bigint") == [0, 1, 1]


def test_released_in_last_days_exact_days_only(spark):
    vals = ["2024-11-08", "2024-11-14", "2024-11-15", "2024-11-07", "2024", "2024-11", None]
    got = one_col(spark, vals, lambda c: released_in_last_days(c, "2024-11-15"))
    assert got == [True, True, False, False, False, False, False]


def test_array_helpers(spark):
    df = spark.createDataFrame(
        [([("a", "1"), ("b", "2")], []), ([("c", "3")], [("u",)])],
        "artists array<struct<name:string,id:string>>, images array<struct<url:string>>")
    got = df.select(join_names("artists").alias("n"), first_or_null("images")["url"].alias("u")).collect()
    assert [tuple(r) for r in got] == [("a, b", None), ("c", "u")]
