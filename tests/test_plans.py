"""Physical-plan assertions: pushdown, pruning, no nested-loop or
single-partition plans where the data grows, no Python in the hot path."""

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

Q = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_mart_pushdown_and_pruning(spark):
    f = formatted(Q["wide_fact_mart"](spark, SF_SMALL))
    assert "EqualTo(o_orderstatus,F)" in f
    assert "GreaterThanOrEqual(o_orderdate" in f
    li = [ln for ln in f.splitlines() if ln.startswith("ReadSchema: struct<l_orderkey")]
    assert li and "l_tax" not in li[0]


@pytest.mark.parametrize("name", ["disjunctive_join", "cutoff_join", "weather_fact_mart",
                                  "pair_sum_match", "self_join_compare"])
def test_no_nested_loop_join(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_not_in_is_an_equi_anti_join(spark):
    p = plan(Q["null_aware_anti_join"](spark, SF_SMALL))
    assert "LeftAnti" in p and "NestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["running_sum", "lag_lead_runs", "asof_left_join",
                                  "rank_top_n", "dense_rank_top_n", "local_minimum",
                                  "window_min", "gap_detection"])
def test_no_single_partition_window(spark, name):
    """The only single-partition exchanges allowed feed a global partial
    aggregate (one row per task, e.g. the bucket bounds)."""
    lines = [ln.strip(" :+-") for ln in plan(Q[name](spark, SF_SMALL)).splitlines()]
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            assert "HashAggregate(keys=[]" in lines[i + 1], lines[i:i + 3]


def test_month_partition_pruning(spark):
    f = formatted(Q["month_partitioned_table"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(ym" in f and "ym#" in f


@pytest.mark.parametrize("name", ["json_extract", "sql_scalar_udf", "timestamp_parse",
                                  "regex_strip", "mart_cube_report", "running_sum"])
def test_no_python_udf(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_partial_aggregation_before_shuffle(spark):
    p = plan(Q["latest_by_key"](spark, SF_SMALL))
    assert "partial_max_by" in p


def test_wide_mart_runs_once_under_its_probes(spark):
    """J17 reads its facts once and neither shuffles nor sorts them for the two probes."""
    p = Q["weather_fact_mart"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert p.count("lineitem.parquet") == 1 and p.count("Window") <= 4  # of the series' slots
    facts = p[:p.index("lineitem.parquet")]
    assert "asof" not in facts and "hashpartitioning(_l" not in p


def test_cube_adds_rows_up_before_copying(spark):
    p = Q["cube_report"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for part in p.split("Expand ")[1:]:
        assert "partial_sum" in part.split("FileScan")[0]
