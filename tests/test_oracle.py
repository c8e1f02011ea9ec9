"""Every query with SQL agrees with DuckDB on the small tables."""

import pytest
from oracle_compare import connect, difference

from __spark_entry__ import entry
from sharelens.plans.oracle import ORACLE_SQL
from sharelens.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    assert difference(con, QUERIES[name](spark, SF_DIR), ORACLE_SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["triple_id", "candidate_voter_list"]
    assert frame.count() > 0
