"""Registered queries: SQL results on the smallest tables, and their columns."""

import os

import pytest

from millrace.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_statement(spark, name):
    assert difference(QUERIES[name](spark, SF), database(SF), ORACLE_SQL[name]) is None
