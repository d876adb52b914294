"""Values that fall on limits, absent and infinite values, and work that ends without leaving files."""

import math
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.functions.numeric import half_up
from ledgerlens.operators import clean, dashboard, evaluate, explore, features, reports, sampling
from ledgerlens.plans import pipelines
from ledgerlens.plans.quantiles import quantile_table
from ledgerlens.sources import files, fixtures


def _amounts(spark, values, label=1):
    rows = [(i, float(i * 3600), float(v), label) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id bigint, time_seconds double, amount double, class int")


def test_flags_compare_unrounded(spark):
    thirds = _amounts(spark, [i + 1 / 3 for i in range(101)])
    assert features.feat_high_value_flag(thirds).agg(F.sum("high_value_flag")).first()[0] == 1
    assert features.feature_pipeline(thirds).agg(F.sum("high_value_flag")).first()[0] == 1
    assert reports.q06_fraud_above_p95(thirds).count() == 5
    tiny = _amounts(spark, [1e-13 * i for i in range(1000)])
    assert features.feat_high_value_flag(tiny).agg(F.sum("high_value_flag")).first()[0] == 10
    assert features.feature_pipeline(tiny).agg(F.sum("high_value_flag")).first()[0] == 10


def test_fences_compare_unrounded(spark):
    assert explore.eda_box_stats(_amounts(spark, [1e-12 * i for i in range(101)])).first()["outliers"] == 0


def test_large_and_infinite_numbers_pass_through_rounding(spark):
    df = spark.createDataFrame([(2e18,), (math.inf,), (-math.inf,), (2.5e-7,), (None,)], "x double")
    assert [r[0] for r in df.select(half_up(F.col("x"), 6)).collect()] == [2e18, math.inf, -math.inf, 0.0, None]


@pytest.mark.parametrize("limit", [10**6, 10])
def test_quantiles_with_infinite_and_absent_values(spark, limit):
    values = [float(i) for i in range(50)] + [math.inf, -math.inf, None, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = quantile_table(df, "x", [0.0, 0.5, 0.75, 1.0], limit=limit).first()
    assert row["quantiles"] == [-math.inf, 24.5, 37.25, math.inf]


@pytest.mark.parametrize("limit", [10**6, 10])
def test_rows_without_a_score_have_no_place_in_a_curve(spark, limit):
    rows = [(i, i % 2, i / 50, int(i > 25)) for i in range(50)]
    odd = [(90, 1, None, 0), (91, 0, math.nan, 1), (92, 1, math.inf, 1)]
    schema = "id bigint, label int, prob double, prediction int"
    df, known = spark.createDataFrame(rows + odd, schema), spark.createDataFrame(rows + odd[2:], schema)
    for table in (evaluate.roc_auc, evaluate.average_precision, evaluate.roc_curve, evaluate.pr_curve):
        assert table(df, limit=limit).collect() == table(known, limit=10**6).collect()


def test_correlations_of_rows_with_both_values(spark):
    rows = [(float(i), float(i * i), None if i % 3 else 2.0 * i, 7.0, math.nan if i == 4 else -i + 0.5) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, d double")
    pairs = [("a", "b"), ("a", "c"), ("a", "flat"), ("a", "d"), ("b", "a")]
    found = {(r.column_a, r.column_b): r.r for r in explore.correlations(df, pairs).collect()}

    def r(x, y):
        both = [(p, q) for p, q in zip(x, y) if p is not None and q is not None and p == p and q == q]
        mx, my = (sum(v) / len(both) for v in zip(*both))
        sxy = sum((p - mx) * (q - my) for p, q in both)
        return sxy / math.sqrt(sum((p - mx) ** 2 for p, _ in both) * sum((q - my) ** 2 for _, q in both))

    a, b, c, _, d = zip(*rows)
    assert found[("a", "flat")] is None
    for pair, want in {("a", "b"): r(a, b), ("a", "c"): r(a, c), ("a", "d"): r(a, d), ("b", "a"): r(a, b)}.items():
        assert found[pair] == pytest.approx(want, abs=1e-6)


def test_audit_table_is_complete_and_numbered(spark):
    df = _amounts(spark, [i % 37 for i in range(1200)]).withColumn("amount", F.when(F.col("id") != 5, F.col("amount")))
    rows = sorted(dashboard.report_flagged(df).collect())
    assert dashboard.report_flagged(df).schema["txn_no"].dataType.typeName() == "long"
    assert [r.txn_no for r in rows] == list(range(1, 1201))
    amounts = [r.amount for r in rows]
    assert amounts[:-1] == sorted(amounts[:-1], reverse=True) and amounts[-1] is None
    assert [r.id for r in dashboard.report_flagged(df, limit=3).collect()] == [r.id for r in rows[:3]]


def test_cleaned_table_feeds_every_later_step(spark, sf_small, tmp_path):
    raw = files.transactions_to_raw(fixtures.transactions(spark, sf_small))
    files.save(raw.unionByName(raw.limit(50)), f"{tmp_path}/raw")
    cleaned = pipelines.clean_pipeline(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    assert cleaned.agg(F.count_distinct("id"), F.count(F.lit(1))).first() == (1000, 1000)
    again = pipelines.clean_pipeline(spark, f"{tmp_path}/raw", f"{tmp_path}/again")
    assert again.exceptAll(cleaned).isEmpty()
    splits = pipelines.features_and_splits(cleaned, f"{tmp_path}/features", f"{tmp_path}/splits")
    parted = splits.where("NOT is_synthetic").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in parted} == {"train": 800, "test": 200}
    balance = splits.where("split = 'train'").groupBy("class").count().collect()
    assert len({r["count"] for r in balance}) == 1
    report = pipelines.report_build(
        cleaned, fixtures.scored(spark, sf_small), fixtures.scored_models(spark, sf_small), f"{tmp_path}/report", "amount_scaled"
    )
    assert report["flagged"].count() == 60


def test_scratch_of_a_finished_step_is_deleted(spark, tmp_path):
    kept = list(session._scratch_paths)
    with session.scratch_scope(spark):
        stored = session.materialize(spark.range(10), "test")
        path = session._scratch_paths[-1].removeprefix("file:")
        assert os.path.isdir(path) and stored.count() == 10
    assert not os.path.isdir(path) and session._scratch_paths == kept


def test_scratch_goes_to_the_shared_folder(spark, tmp_path, monkeypatch):
    class Conf:
        get = staticmethod(lambda key, default: f"file://{tmp_path}/shared/" if key == "spark.checkpoint.dir" else default)

    class Session:
        conf = Conf

    root = session.scratch_root(Session)
    assert root == f"file://{tmp_path}/shared"
    monkeypatch.setattr(session, "scratch_root", lambda _: root)
    rows = [(i % 5, float(i % 7), *[0.0] * 8) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b double, " + ", ".join(f"c{i} double" for i in range(8)))
    assert clean.dedup_rows(df).count() == 35
    assert any(name.startswith("ledgerlens-") for name in os.listdir(f"{tmp_path}/shared"))


def test_copies_grow_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPY_BLOCK", 3)
    rows = [(i, int(i < 8), float(i % 5), float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, class int, x double, y double")
    grown = sampling.smote(df, ["x", "y"]).where("is_synthetic")
    sizes = grown.groupBy("id").agg(F.count(F.lit(1)), F.count_distinct("copy_no"), F.max("copy_no")).collect()
    assert sum(r[1] for r in sizes) == 284 and all(r[1] == r[2] == r[3] for r in sizes)
