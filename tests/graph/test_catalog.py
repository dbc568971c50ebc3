"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from tests.parity import compare, duck
from tidegraph.plans import catalog


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, small, con, name):
    df = catalog.QUERIES[name](spark, small)
    compare(df, con, catalog.ORACLE_SQL[name])


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["followee_id", "in_degree"]
