"""Every registered query against its SQL statement in DuckDB, and its plan."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from helpers import plan_of

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402
from flightloom.fixtures import oracle  # noqa: E402
from flightloom.fixtures.queries import registered  # noqa: E402
from tools.compare import difference  # noqa: E402

SF = "/root/testdata/sf0.001"
STATEMENTS = oracle.statements()
QUERIES = registered()

# Plans hold no cross join and no row-wise Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_statement(spark, duck, name):
    result = QUERIES[name](spark, SF)
    plan = plan_of(result)
    assert not [operator for operator in UNWANTED if operator in plan]
    ours = result.toArrow()
    theirs = duck.sql(STATEMENTS[name]).to_arrow_table()
    assert difference(ours, theirs) is None


def test_entry_has_rows(spark):
    found = spark_entry.entry(spark)
    assert found.columns == ["airport_name", "city", "total_flights"]
    assert found.count() > 0


def test_statements_belong_to_queries():
    assert set(STATEMENTS) == set(QUERIES)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
