"""Every registered query against its SQL on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql
from tests.conftest import SMALL
from workload import QUERIES, compare


@pytest.fixture(scope="module")
def db():
    return compare.database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert name in oracle_sql()
    # A few queries are empty on this data (no day has every quote); SQL must agree.
    mine = compare.spark_rows(spark, SMALL, name)
    assert compare.difference(mine, compare.sql_rows(db, name)) is None


def test_entry(spark):
    assert entry(spark).columns == ["brand", "instrument", "r", "n"]
