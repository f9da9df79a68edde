"""Every registered query against its SQL in DuckDB, over whole tables."""

import os

import pytest
from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, connection, name):
    df = queries()[name](spark, SF_DIR)
    if name in oracle_sql():
        assert difference(df, oracle_sql()[name], connection) is None
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["subject_code", "session_id"]
