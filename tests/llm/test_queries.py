"""The registered queries on the smallest tables, against DuckDB where SQL can express them."""

import pytest

import __spark_entry__ as E
from velostat.llm.oracle import LLM_ORACLE
from velostat.llm.queries import LLM_QUERIES
from velostat.plans.compare import duckdb_views, same_result

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, name):
    ok, why = same_result(LLM_QUERIES[name](spark, SF), duckdb_views(SF), LLM_ORACLE[name])
    assert ok, why


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLE)) + ["pipeline"])
def test_query_runs_on_whole_tables(spark, name):
    table = "pages" if name.startswith("op5") else "documents"
    whole = spark.read.parquet(f"{SF}/{table}.parquet").count()
    rows = E.queries()[name](spark, SF).count()
    assert rows == whole if name != "pipeline" else rows > 0
