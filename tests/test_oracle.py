"""Every registered query against its DuckDB oracle SQL on the smallest driver data."""

import pytest

import __spark_entry__ as E
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in E.queries().items() if k.startswith("q_")}
SQL = {k: v for k, v in E.oracle_sql().items() if k.startswith("q_")}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["group_raw_1", "group_raw_2", "credit", "gmv", "fees", "orders"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, ns, nd, _, detail = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert ok, f"{name}: spark={ns} duck={nd} {detail}"
    assert ns > 0, f"{name} returned no rows"
