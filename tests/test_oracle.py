"""Every registered query with SQL against its SQL, names, types and rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import compare, connect

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    assert compare(queries()[name](spark, sf_dir), con, ORACLES[name]) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and "avg_ratio" in rows[0].asDict()
