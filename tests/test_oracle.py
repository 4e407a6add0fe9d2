"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from registry.compare import compare, connect

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in SQL:
        assert QUERIES[name](spark, SF_DIR).count() > 0
        return
    equal, text = compare(spark, con, QUERIES[name], SQL[name], SF_DIR)
    assert equal, text


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
