"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import plan_of

from __spark_entry__ import entry, oracle_sql, queries
from argulith.catalog import ORACLES, QUERIES
from check import compare, connect


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, connection, key):
    good, note = compare(spark, connection, sf_dir, key)
    assert good, note
    assert "types differ" not in note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["split", "label", "n", "chars"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_query_pairs_up_rows(spark, sf_dir, key):
    if key in {"train_classifier", "model_io", "corpus_to_index", "leakage_audit", "stream_score"}:
        return  # their plans read staged results
    plan = plan_of(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
