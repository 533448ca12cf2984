"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, TWINS = entry.queries(), entry.oracle_sql()
# At this size no series is long enough for the whole horizon, so an empty result is right on both sides.
FITTING = {"k1_families", "k3_grid", "k8_batch_scores", "k9_predict", "k10_evaluate", "b10_model_roundtrip"}
FITTING |= {"k8_scored_keys", "k9_predicted_keys", "k_one_split"}
# Models need the longer series of the next size; there, none of their results is empty.
LONGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in FITTING))
def test_query(spark, con, name):
    assert differences(spark, con, QUERIES[name], TWINS.get(name), SF) in (None, "no rows")


@pytest.mark.parametrize("name", sorted(n for n in FITTING if n in TWINS))
def test_fitting_query(spark, name):
    assert differences(spark, connect(LONGER), QUERIES[name], TWINS[name], LONGER) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(QUERIES)
