"""Every query key against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from worklake.plans.queries import QUERIES

KEYS = list(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_key_has_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, sf_small, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], sf_small)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["topic", "papers"] and len(rows) == 10
