"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect
from tidewatch.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_twins_have_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(registry.ORACLES) == set(registry.QUERIES)


def test_checker_fails_without_a_twin(spark, con, monkeypatch):
    monkeypatch.setattr(contract, "oracle_sql", dict)
    assert compare(spark, con, SF_DIR, "token_cost") [0] is False
