"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness scale): same row count, column names and multiset of rows."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tests.oracle_compare import compare, duck

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, QUERIES[name], ORACLE[name], SF001)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 150
    assert df.columns[0] == "id"
