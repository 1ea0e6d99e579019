"""Registered queries against their SQL twins on the smallest data; the rest run in ``oracle_check.py``."""

import os

import pytest

import __spark_entry__ as entry
from lexanchor.plans.registry import ORACLE, QUERIES
from oracle_check import compare, connect

DIR = "/root/testdata/sf0.001"
PICK = [
    "agg3_relator_profile", "agg8_subject_environment_profile", "win1_current_state", "jn6_anchored_decisions", "lnk10_unify_anchors",
    "win9_segment_blocks", "txt6_assign_parents", "lnk7_match_blocks", "rec4_fix_boundaries", "val7_contract_events", "gr1_tree_closure",
    "gr5_causation_chain", "vec3_nearest_plates_tiled", "fn29_vector_literal", "txt12_confirmed_metadata", "str2_current_state_stream",
]
NAMES = list(QUERIES) if os.environ.get("ALL_QUERIES") else PICK


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_twin(spark, con, name):
    error, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), DIR)
    assert error is None, error


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
