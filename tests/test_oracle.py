"""Every registered query against its DuckDB oracle on the smallest test scale."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck_connect
from conftest import SF_SMALL

SLOW = {"als_grid"}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = df.toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.execute(sql).df()
    res = compare(got, want)
    assert res["rows_ok"] and res["cols_ok"] and res["hash_ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["genre", "rank", "mid", "avg_score"]
    assert df.count() > 0
