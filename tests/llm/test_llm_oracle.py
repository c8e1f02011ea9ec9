"""Queries with SQL agree with DuckDB; all of them are registered."""

import pytest
from oracle_compare import connect, difference

import __spark_entry__
from sharelens.llm.oracle import ORACLE_SQL
from sharelens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert difference(connect(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLE_SQL[name]) is None


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())
