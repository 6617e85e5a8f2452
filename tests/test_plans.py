"""Shapes of physical plans: what is read, what is shuffled."""

import re

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return re.findall(r"Exchange (\w+)", plan)


def test_only_needed_columns_are_scanned(spark, folder):
    plan = plan_of(QUERIES["feature_panel_exact"](spark, folder))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == [
        "l_suppkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz"
    ]


def test_filters_reach_the_scan(spark, folder):
    plan = plan_of(QUERIES["snowflake_join_chain"](spark, folder))
    for pushed in ("EqualTo(n_name,NATION_7)", "EqualTo(l_returnflag,R)", "LessThan(l_quantity,25.0)", "EqualTo(o_orderstatus,F)"):
        assert pushed in plan


def test_panel_shuffles_once_per_axis(spark, folder):
    # two for the derived results, one for the period axis, one for the season axis, one for the final sort
    assert len(exchanges(plan_of(QUERIES["feature_panel_exact"](spark, folder)))) == 5
    # the season axis disappears when nobody asks for it
    assert len(exchanges(plan_of(QUERIES["prev_period_position"](spark, folder)))) == 3


def test_data_is_never_gathered_into_one_partition(spark, folder):
    for name in ("feature_panel_exact", "session_pivot", "last_value_per_key", "insert_if_absent", "range_slice"):
        assert "SinglePartition" not in plan_of(QUERIES[name](spark, folder)), name
