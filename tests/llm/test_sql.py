"""The queries of this package that SQL can express, on the smallest driver tables."""

import os

import pytest

from compare import connect, difference
from dockflow.llm.oracles import oracle_sql
from dockflow.llm.queries import queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None
