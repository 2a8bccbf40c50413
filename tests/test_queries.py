"""Every registered query against its SQL (whole tables at the small scale factor)."""

import os

import oracle
import pytest

import __spark_entry__ as entry_point

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
