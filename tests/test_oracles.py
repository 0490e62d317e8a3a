"""Every registered query against its DuckDB oracle on the smallest test data
(rows-only queries must run and return rows)."""

import pytest

from conftest import SF
from oracle_harness import compare, duck
from tidemark.plans.registry import load_all

QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SF)
    if r["ok"] is None:
        assert r["rows"] > 0
    else:
        assert r["ok"], r.get("why")


def test_entry_contract(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
