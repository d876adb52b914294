import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import dashboard, explore, reports
from ledgerlens.sources import fixtures

SCHEMA = "id bigint, time_seconds double, amount double, class int"


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [(1, 0.0, 10.0, 0), (2, 0.0, 600.0, 1), (3, 0.0, 600.0, 1), (4, 40000.0, 60.0, 1), (5, 80000.0, 700.0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def no_fraud(spark):
    return spark.createDataFrame([(1, 0.0, 10.0, 0), (2, 5.0, 20.0, 0)], SCHEMA)


def test_no_fraud(no_fraud):
    assert reports.q06_fraud_above_p95(no_fraud).count() == 0
    assert reports.q02_top_fraud(no_fraud).count() == 0
    for query in (reports.q08_threshold_coverage, reports.q08_threshold_coverage_join):
        rows = query(no_fraud).collect()
        assert len(rows) == 7
        assert all((r.fraud_above_threshold, r.total_fraud, r.pct_fraud_captured) == (0, 0, None) for r in rows)
    row = reports.q11_hour_range_share(no_fraud).first()
    assert (row.fraud_in_range, row.total_fraud, row.pct_of_all_fraud) == (0, 0, None)
    flags = no_fraud.withColumn("high_risk_hour", F.lit(0))
    assert [r.of_total for r in explore.fe_fraud_by_risk_flag(flags).collect()] == ["0 / 0", "0 / 0"]


def test_all_fraud(spark):
    df = spark.createDataFrame([(i, float(i), 100.0, 1) for i in range(1, 6)], SCHEMA)
    assert [r.percentage for r in reports.q01_class_distribution(df).collect()] == [100.0]
    streaks = reports.q09_fraud_streaks(df).collect()
    assert [(r.id, r.fraud_in_last_10) for r in streaks] == [(3, 3), (4, 4), (5, 5)]
    assert reports.q06_fraud_above_p95(df).count() == 0


def test_one_row(spark):
    df = spark.createDataFrame([(1, 0.0, 10.0, 1)], SCHEMA)
    row = reports.q03_amount_by_class(df).first()
    assert (row.avg_amount, row.median_amount, row.max_amount, row["count"]) == (10.0, 10.0, 10.0, 1)
    assert reports.q02_top_fraud(df).first().amount_z_score == 0.0


def test_ties_follow_the_id(tiny):
    assert [r.id for r in reports.q02_top_fraud(tiny, n=1).collect()] == [2]
    assert [r.transaction_id for r in reports.q10_audit_flags(tiny).collect()] == [2, 3, 4]
    assert [r.risk_level for r in reports.q10_audit_flags(tiny).collect()] == ["CRITICAL", "CRITICAL", "LOW"]


def test_threshold_forms_agree(spark, sf_check):
    df = fixtures.transactions(spark, sf_check, vectors=False)
    marks = (0, 55, 300, 99999)
    assert reports.q08_threshold_coverage(df, marks).collect() == reports.q08_threshold_coverage_join(df, marks).collect()


def test_approximate_forms_run(spark, sf_check):
    df = fixtures.transactions(spark, sf_check, vectors=False)
    exact = reports.q03_amount_by_class(df).orderBy("transaction_type").collect()
    rough = reports.q03_amount_by_class(df, approx=True).orderBy("transaction_type").collect()
    for a, b in zip(exact, rough):
        assert b.median_amount == pytest.approx(a.median_amount, rel=0.02)
    assert abs(reports.q06_fraud_above_p95(df, approx=True).count() - 30) <= 2


def test_histogram_counts_everything(spark, sf_check):
    df = fixtures.transactions(spark, sf_check, vectors=False)
    table = explore.eda_amount_histogram(df)
    assert table.count() == 160
    assert table.agg(F.sum("n")).first()[0] == df.count()
    same = spark.createDataFrame([(0, 2.0), (0, 2.0)], "class int, amount double")
    rows = explore.histogram(same, "amount", 4).orderBy("bin").collect()
    assert [r.n for r in rows] == [0, 0, 2, 0] and rows[0].bin_start == 1.5 and rows[-1].bin_end == 2.5


def test_box_of_constant_values(spark):
    df = spark.createDataFrame([(1, 3.0)] * 4, "class int, amount double")
    row = explore.eda_box_stats(df).first()
    assert (row.q1, row.median, row.q3, row.whisker_low, row.whisker_high, row.outliers) == (3.0, 3.0, 3.0, 3.0, 3.0, 0)


def test_flagged_rows_without_optional_columns(tiny):
    rows = dashboard.report_flagged(tiny, limit=2).collect()
    assert [(r.txn_no, r.id, r.hour_of_day, r.risk_level) for r in rows] == [(1, 2, 0, "LOW"), (2, 3, 0, "LOW")]
    assert dashboard.report_hourly(tiny).first().hour == 0


def test_formatted_summary(spark, sf_small):
    df = fixtures.transactions(spark, sf_small, vectors=False)
    text = dashboard.report_summary_formatted(dashboard.report_summary(df, fixtures.scored(spark, sf_small)))
    cells = {r.metric: r.value for r in text.collect()}
    assert cells["Total Transactions"] == "1,000" and cells["Fraud Rate"] == "6.0000%"
    assert cells["Max Fraud Amount"].startswith("$") and len(cells) == 9


def test_summary_without_the_amount_column(spark, sf_small):
    df = fixtures.transactions(spark, sf_small, vectors=False)
    row = dashboard.report_summary(df, fixtures.scored(spark, sf_small), amount_col="not_there").first()
    assert (row.avg_legit_amt, row.avg_fraud_amt, row.max_fraud_amt) == (0.0, 0.0, 0.0)
