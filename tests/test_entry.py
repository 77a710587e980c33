import pytest

import __spark_entry__ as E
from chartmart.plans import registry
from conftest import SF_SMALL
from oracle_harness import compare, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date_key", "total_streams", "avg_rank"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.queries()) <= set(E.queries()) and set(registry.queries()) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, con)
    assert r["status"] == "match", r
    assert not r.get("type_diff"), r
