"""Every registered query against its DuckDB oracle (sf0.001), the same
check the driver runs at sf0.01."""

import pytest

import __spark_entry__ as entry
from tidewater.plans.queries import all_oracles, all_queries
from compare import duck, same_rows
from conftest import SF_SMALL

QUERIES = all_queries()   # the training-data queries have tests of their own
ORACLES = all_oracles()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    same_rows(QUERIES[key](spark, SF_SMALL), con, ORACLES[key])


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["MMSI", "ReportCount"]
    assert df.count() > 0
