"""Queries against their SQL twins on the smallest data."""

import pytest

from lexanchor.llm.queries import ORACLE, QUERIES
from oracle_check import compare, connect

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_twin(spark, name):
    error, _ = compare(spark, connect(DIR), name, QUERIES[name], ORACLE[name], DIR)
    assert error is None, error
