from chartmart.operators.quality import (check_fanout, check_foreign_key, check_key, check_not_null, check_result,
                                         check_type, check_unique, run_checks)
from conftest import rows


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)], "name string, v bigint")
    assert check_not_null(df, "name").count() == 2
    assert rows(check_unique(df, "name")) == [("a", 2)]  # NULL ignored
    rep = run_checks([check_result(check_unique(df, "name"), "u"), check_result(check_not_null(df, "v"), "n"),
                      check_type(df, "v", "number"), check_type(df, "name", "number")])
    assert rows(rep) == [("n", 1, True, True), ("type_number_name", 1, True, True),
                         ("type_number_v", 0, False, False), ("u", 1, True, True)]


def test_key_foreign_key_fanout(spark):
    li = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 1)], "o bigint, ln bigint")
    assert rows(check_key(li, ["o", "ln"])) == [(1, 1, 2), (2, None, 1)]
    orders = spark.createDataFrame([(1,), (2,)], "o bigint")
    assert rows(check_foreign_key(li, orders, "o")) == [(3, 1)]
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k bigint, nat string")
    assert rows(check_fanout(dim, ["nat"])) == [("a", 2)]
