"""The shape of the physical plans."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import clean, explore, features, reports, sampling
from ledgerlens.operators.neighbours import nearest_neighbours
from ledgerlens.session import materialize
from ledgerlens.sources import fixtures


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def narrow(spark, sf_check):
    return fixtures.transactions(spark, sf_check, vectors=False)


def test_top_fraud_is_a_top_k(narrow):
    assert "TakeOrderedAndProject" in _plan(reports.q02_top_fraud(narrow))


def test_only_needed_columns_are_read(narrow):
    plan = _plan(reports.q05_fraud_rate_by_hour(narrow))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_label_filter_reaches_the_scan(spark, narrow):
    table = materialize(narrow, "test-table")
    plan = _plan(reports.q02_top_fraud(table))
    assert "EqualTo(class,1)]" in plan and "ReadSchema: struct<id:bigint,time_seconds:double,amount:double,class:int>" in plan


def test_reports_have_no_cross_join_or_python(narrow):
    queries = [
        reports.q01_class_distribution,
        reports.q03_amount_by_class,
        reports.q06_fraud_above_p95,
        reports.q07_time_blocks,
        reports.q08_threshold_coverage,
        reports.q10_audit_flags,
        explore.eda_amount_histogram,
        explore.eda_box_stats,
        features.quantile_threshold,
        clean.standard_scale,
    ]
    for query in queries:
        plan = _plan(query(narrow))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, query.__name__
        assert "Python" not in plan and "Pandas" not in plan, query.__name__


def test_join_form_only_meets_counted_rows(narrow):
    plan = _plan(reports.q08_threshold_coverage_join(narrow))
    assert "CartesianProduct" not in plan
    # The side of the inequality join that comes from the table is aggregated first.
    nested = plan[plan.index("BroadcastNestedLoopJoin") :]
    assert nested.index("HashAggregate") < nested.index("FileScan")


def test_streaks_do_not_sort_transactions_in_one_task(narrow):
    streaks = reports.q09_fraud_streaks(narrow)
    plan = _plan(streaks)
    # Only the last rows of each range, as many as a frame has, go to a single task.
    after = plan.split("Exchange SinglePartition")[1:]
    assert len(after) == 1 and "_last" in after[0].splitlines()[1] and "_pos" in after[0].splitlines()[1]


def test_correlations_stay_in_the_jvm(spark, sf_check):
    plan = _plan(explore.eda_correlation_matrix(fixtures.transactions(spark, sf_check)))
    assert "Python" not in plan and "Arrow" not in plan and "HashAggregate" in plan


def test_split_does_not_shuffle(narrow):
    assert "Exchange" not in _plan(sampling.stratified_split(narrow)).split("Subquery")[0]


def test_copies_are_limited_before_the_shuffle(spark):
    points = spark.range(50).select("id", F.array(F.lit(1.0), (F.col("id") % 3).cast("double")).alias("x"))
    plan = _plan(nearest_neighbours(points, 5))
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_synthetic_rows_are_not_shuffled(spark, narrow):
    table = narrow.withColumn("hour", F.lit(1))
    plan = _plan(sampling.smote(table, ["amount", "time_seconds", "hour"]).where("is_synthetic"))
    # Nothing above the step that multiplies the rows moves them.
    assert "Exchange" not in plan[: plan.index("Generate explode(sequence")]
