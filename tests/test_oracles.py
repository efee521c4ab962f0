"""Every registered query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL
from tests.oracle_check import compare, connect

SQLS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, SMALL, name, queries()[name], SQLS.get(name)) == ""


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(queries())


def test_entry(spark):
    assert set(entry(spark).columns) == {"status", "n", "amount"}
    assert entry(spark).count() > 0
