"""Every registered query that has SQL, compared with DuckDB value by value."""

import oracle
import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    assert oracle.differences(df, con, SQL[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert banned not in plan


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and {"fin_pos", "previous_race_pos"} <= set(rows[0].asDict())
