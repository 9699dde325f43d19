"""Every registered query against its SQL, columns, types and all rows."""

import pytest

import __spark_entry__ as entry
from against_sql import connect, differences
from remitlake.plans import oracle, registry

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 83
