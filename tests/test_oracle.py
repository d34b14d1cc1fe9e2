"""Every registered query against its SQL on the smallest tables."""

import pytest
from tests.oracle import compare, duck

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"
# Training runs of several seconds each; covered once by test_training.
SLOW = {"m1_to_m4_candidates", "m24_select_model", "m18_score_titles", "m23_train_title_model", "e9_title_scores"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract():
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.oracle_sql()) >= 100


@pytest.mark.parametrize("name", sorted(e.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    problems = compare(spark, con, e.queries()[name], e.oracle_sql()[name], SF)
    # At the smallest scale some tables have no row for a rare value.
    assert [p for p in problems if p != "empty"] == []


@pytest.mark.parametrize("name", sorted(set(e.queries()) - set(e.oracle_sql()) - SLOW))
def test_query_runs(spark, name):
    assert e.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert e.entry(spark).count() > 0
