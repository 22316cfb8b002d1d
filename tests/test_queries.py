"""Every registered query beside its SQL on the smallest data."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from changelake.plans.oracle import ORACLE as SQL
from changelake.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
