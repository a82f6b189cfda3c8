"""Plan-shape guards for the scale properties the design relies on."""

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark):
    plan = _plan(E.queries()["metric_daily"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "props" not in plan                         # unused column never read
    assert "_slice" in plan                            # reports are windowed per (key, second)
    assert plan.count("events.parquet") <= 3           # the reports, the days to report on, the served history


def test_no_job_runs_while_a_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan")
    try:
        E.queries()["metric_daily"](spark, SF_SMALL)
        # reading a table's footer for its schema is the only job
        assert len(tracker.getJobIdsForGroup("plan-only")) <= 5
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fuzzy_match_has_no_cross_product(spark):
    plan = _plan(E.queries()["win_best_match"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_spine_is_an_equi_join(spark):
    plan = _plan(E.queries()["join_county_spine"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_comparison_is_one_pass(spark):
    for name in ("join_compare", "qa_compare_tolerance"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert plan.count("events.parquet") <= 3       # as many scans as one run has
