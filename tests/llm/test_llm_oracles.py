"""The SQL of the queries that SQL can express."""

import pytest
from compare import difference, oracle_connection

from emberlog.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) is None
