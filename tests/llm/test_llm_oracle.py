"""Each corpus query with SQL against DuckDB on the same tables."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from worklake.llm.queries import ORACLE_SQL


@pytest.mark.parametrize("key", list(ORACLE_SQL))
def test_key_matches_oracle(spark, sf_small, key):
    r = compare(spark, duck(sf_small), key, E.queries()[key], E.oracle_sql()[key], sf_small)
    assert r["ok"], r
