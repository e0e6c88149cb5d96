"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
import oracle
from truerow.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in all_queries().items() if sql))
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert oracle.difference(frame, duck, contract.oracle_sql()[name]) is None
