"""Every catalogue query against its DuckDB oracle (sf0.001), plus the driver contract."""

import pytest

from conftest import SF0001

import __spark_entry__ as entry_mod
from ledgerlens.plans import catalog
from ledgerlens.plans.verify import compare

ORACLE_QUERIES = sorted(catalog.ORACLE)
ROWS_ONLY = sorted(set(catalog.QUERIES) - set(catalog.ORACLE))


def test_contract():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "id"


@pytest.mark.parametrize("name", ORACLE_QUERIES)
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF0001)
    assert r["status"] in ("exact", "close"), r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF0001).count() > 0
