"""Every query of the registry against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from qualstar.plans import registry
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["dq_classification", "record_count"]
    assert df.count() == 3


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert ok, msg
