"""Every registered query against its DuckDB oracle on the smallest data."""
import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.own_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    r = compare(df, con, sql)
    assert r["cols_match"] and r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "order_id" in df.columns
