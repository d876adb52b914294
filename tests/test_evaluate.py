import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate
from ledgerlens.sources import fixtures


@pytest.fixture(scope="module")
def scored(spark, sf_check):
    return fixtures.scored(spark, sf_check).cache()


def test_area_equals_the_built_in_evaluator(scored):
    built_in = BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="label", numBins=0).evaluate(scored)
    assert evaluate.roc_auc(scored, digits=9).first().roc_auc == pytest.approx(built_in, abs=1e-9)


def test_area_of_reversed_scores(scored):
    flipped = scored.withColumn("prob", 1 - F.col("prob"))
    total = evaluate.roc_auc(scored).first().roc_auc + evaluate.roc_auc(flipped).first().roc_auc
    assert total == pytest.approx(1.0, abs=2e-6)


def test_ranges_do_not_change_curves(scored):
    for curve in (evaluate.roc_curve, evaluate.pr_curve, evaluate.roc_auc, evaluate.average_precision):
        assert sorted(map(str, curve(scored).collect())) == sorted(map(str, curve(scored, limit=10).collect()))


def test_one_class_only(scored):
    negatives = scored.where("label = 0")
    assert evaluate.roc_auc(negatives).first().roc_auc is None
    assert evaluate.average_precision(negatives).first().average_precision is None
    row = evaluate.binary_metrics(negatives.withColumn("prediction", F.lit(0))).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)
    assert evaluate.confusion_matrix(negatives).count() == 4


def test_square_matrix(scored):
    cells = {r.cell: r.n for r in evaluate.confusion_matrix(scored).collect()}
    square = {r.row: (r.predicted_0, r.predicted_1) for r in evaluate.confusion_square(scored).collect()}
    assert square == {"Actual Legitimate": (cells["TN"], cells["FP"]), "Actual Fraud": (cells["FN"], cells["TP"])}


def test_all_scores_tied(spark):
    df = spark.createDataFrame([(i, i % 2, 0.5, 0) for i in range(10)], "id bigint, label int, prob double, prediction int")
    assert evaluate.roc_auc(df).first().roc_auc == 0.5
    assert evaluate.average_precision(df).first().average_precision == 0.5
    assert evaluate.roc_curve(df).count() == 2


@pytest.mark.parametrize("limit", [10**6, 12])
def test_collinear_points_are_dropped(spark, limit):
    # One positive, then 40 single negatives: only the ends of the flat run matter.
    rows = [(0, 1, 0.9, 1)] + [(i, 0, 0.9 - i / 50, 0) for i in range(1, 41)]
    df = spark.createDataFrame(rows, "id bigint, label int, prob double, prediction int")
    full = {(r.fpr, r.tpr) for r in evaluate.roc_curve(df, limit=limit).collect()}
    short = [(r.fpr, r.tpr) for r in evaluate.roc_curve(df, drop_collinear=True, limit=limit).collect()]
    assert len(full) == 42 and set(short) <= full and len(short) < 30
    assert {(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)} <= set(short)
    if limit > 12:
        assert sorted(short) == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]


def test_first_model_wins_a_tie(spark, scored):
    table = evaluate.union_models({"one": scored, "two": scored})
    assert evaluate.best_model(table).first().name == "one"
    flags = {r.name: r.is_best for r in evaluate.flag_best(evaluate.model_metrics(table)).collect()}
    assert flags == {"one": True, "two": False}


def test_curves_of_bounded_length(spark):
    rng = np.random.default_rng(5)
    prob = rng.random(4000)
    label = (rng.random(4000) < prob).astype(int)
    scored = spark.createDataFrame(list(zip(range(4000), label.tolist(), prob.tolist(), (prob > 0.5).astype(int).tolist())), "id long, label int, prob double, prediction int")
    for points in (4, 40, 200):
        error = 1 / (points // 4)
        whole = [(r.fpr, r.tpr) for r in evaluate.roc_curve(scored).collect()]
        kept = [(r.fpr, r.tpr) for r in evaluate.roc_curve(scored, max_points=points).collect()]
        assert len(kept) <= points + 1 and set(kept) <= set(whole) and kept[-1] == (1.0, 1.0)
        there = np.array(kept)
        for x, y in whole:
            assert (np.abs(there - (x, y)).max(axis=1)).min() <= error
        whole = [(r.recall, r.precision) for r in evaluate.pr_curve(scored).collect()]
        kept = [(r.recall, r.precision) for r in evaluate.pr_curve(scored, max_points=points).collect()]
        assert len(kept) <= points + 1 and set(kept) <= set(whole)
        there = np.array(kept)
        for x, y in whole:
            near = there[np.abs(there[:, 0] - x) <= error][:, 1]
            assert near.min() <= y <= near.max()
    with pytest.raises(ValueError):
        evaluate.roc_curve(scored, max_points=3)
