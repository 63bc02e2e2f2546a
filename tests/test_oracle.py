"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf 0.01)."""

import pytest

import __spark_entry__ as E
from velostat.plans.catalog import REGISTRY
from velostat.plans.compare import duckdb_views, same_result

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries()) and set(REGISTRY) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    ok, why = same_result(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
    assert ok, why


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["station_id", "station_name", "inbound_trips", "outbound_trips", "net_inflow"]
    assert len(rows) > 0
