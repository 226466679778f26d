"""Every registered query against its SQL, and the contract of the entry module."""

import re

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
# Queries of the training-data package have tests of their own.
OWN_TESTS = re.compile(r"op\d+_|pipeline$")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) is None


def test_only_the_listed_queries_have_no_sql():
    assert [q for q in set(QUERIES) - set(ORACLE) if not OWN_TESTS.match(q)] == []
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["product_key", "total_sales"]
    assert result.count() == 4
