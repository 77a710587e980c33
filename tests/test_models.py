from graphlib import CycleError

import pytest
from conftest import rows

from chartmart.plans.models import Model, plan_models, run_models

KEEP = lambda df: df


def test_order_and_selection():
    models = [Model("c", ("b", "src"), KEEP), Model("a", ("src",), KEEP), Model("b", ("a",), KEEP), Model("d", ("a",), KEEP)]
    order = plan_models(models, ["src"])
    assert sorted(order) == ["a", "b", "c", "d"] and order.index("a") < order.index("b") < order.index("c")
    assert plan_models(models, ["src"], ["b"]) == ["a", "b"] and plan_models([], []) == []
    with pytest.raises(KeyError, match="nothing"):
        plan_models([Model("a", ("nothing",), KEEP)], [])
    with pytest.raises(CycleError):
        plan_models([Model("a", ("b",), KEEP), Model("b", ("a",), KEEP)], [])
    with pytest.raises(ValueError):
        plan_models([Model("src", (), KEEP)], ["src"])


def test_kinds(spark):
    calls = []
    models = [Model("one", ("src",), lambda s: calls.append("one") or s.where("id > 1"), "view"),
              Model("two", ("one",), lambda o: o.selectExpr("id", "id * 2 AS x"), "table"),
              Model("three", ("two", "one"), lambda t, o: t.join(o, "id"), "ephemeral")]
    out = run_models(models, {"src": spark.range(5)}, prefix="models_test_")
    assert rows(out["three"]) == [(2, 4), (3, 6), (4, 8)] and calls == ["one"]
    names = {t.name: t.isTemporary for t in spark.catalog.listTables() if t.name.startswith("models_test_")}
    assert names == {"models_test_one": True, "models_test_two": False}
    spark.sql("DROP TABLE models_test_two")
    spark.catalog.dropTempView("models_test_one")
