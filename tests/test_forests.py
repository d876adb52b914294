"""Nested forests against a walk through the written-out trees."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlens.operators import forests, models


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.random((400, 4)), 2)
    label = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.2, 400)) > 0.8).astype(int)
    rows = [(i, int(y), *map(float, v)) for i, (v, y) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "id long, class int, a double, b double, c double, d double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df).cache(), x, label


def written(model):
    """Every tree as nested (feature, threshold, left, right) or None for a leaf, from the written-out model."""
    out = []
    for text in re.split(r"  Tree \d+ \(weight 1.0\):\n", model.toDebugString)[1:]:
        lines = [line.strip() for line in text.splitlines() if line.strip()]

        def read():
            line = lines.pop(0)
            if line.startswith("Predict"):
                return None
            feature, threshold = re.match(r"If \(feature (\d+) <= (.*)\)", line).groups()
            left = read()
            assert lines.pop(0).startswith("Else")
            return int(feature), float(threshold), left, read()

        out.append(read())
    return out


def walk(node, x, label, row, depth, split_rows, at):
    """Share of class 1 where the row stops; ``at`` are the training rows in the node (no bootstrap: all of them)."""
    if node is None or depth == 0 or len(at) < split_rows:
        return label[at].mean()
    feature, threshold, left, right = node
    goes = x[at, feature] <= threshold
    if row[feature] <= threshold:
        return walk(left, x, label, row, depth - 1, split_rows, at[goes])
    return walk(right, x, label, row, depth - 1, split_rows, at[~goes])


def fit(rows, **params):
    settings = {"numTrees": 6, "maxDepth": 12, "seed": 3, "bootstrap": False, "featureSubsetStrategy": "sqrt"} | params
    return RandomForestClassifier(labelCol="class", **settings).fit(rows)


def test_prefix_depth_and_split_size_equal_a_walk(spark, table):
    rows, x, label = table
    model = fit(rows)
    trees = written(model)
    got = forests.nested_votes(forests.flatten(spark, model), x, [2, 6], [1, 3, 12], [2, 5, 40])
    assert len(got) == 18
    every = np.arange(len(x))
    for (count, depth, least), votes in got.items():
        for i in range(0, len(x), 17):
            want = sum(walk(t, x, label, x[i], depth, least, every) for t in trees[:count])
            assert votes[i] == pytest.approx(want, abs=1e-9)


def test_whole_forest_votes_as_the_model_does(spark, table):
    rows, x, label = table
    model = fit(rows, bootstrap=True)
    votes = forests.nested_votes(forests.flatten(spark, model), x, [6], [12], [2])[6, 12, 2]
    said = [r.probability[1] for r in model.transform(rows).orderBy("id").select("probability").collect()]
    assert votes / 6 == pytest.approx(np.array(said), abs=1e-9)
    counts = forests.count_recalls(model, rows, [6], [12], [2])
    predicted = np.array([r.prediction for r in model.transform(rows).orderBy("id").select("prediction").collect()])
    assert counts == {(6, 12, 2): (int((predicted[label == 1] == 1).sum()), int(label.sum()))}


def test_cut_model_votes_as_its_forest_with_that_split_size(spark, table):
    rows, x, _ = table
    model = fit(rows, bootstrap=True)
    cut = forests.cut_small_nodes(spark, model, 20)
    assert cut.totalNumNodes < model.totalNumNodes and cut.getNumTrees == 6
    votes = forests.nested_votes(forests.flatten(spark, model), x, [6], [12], [20])[6, 12, 20]
    said = [r.probability[1] for r in cut.transform(rows).orderBy("id").select("probability").collect()]
    assert votes / 6 == pytest.approx(np.array(said), abs=1e-9)


def test_search_equals_scoring_every_combination_alone(spark, table):
    """Scores of shared fits are those of the same forests scored one by one; ties go to the first combination."""
    rows, _, _ = table
    grid = {"numTrees": [3, 6], "maxDepth": [2, 12], "minRowsToSplit": [2, 30], "featureSubsetStrategy": ["sqrt", "log2"]}
    df = rows.drop("features")
    found = models.grid_search_forest(df, list("abcd"), grid=grid, folds=3, keys=("id",), bootstrap=False)
    assert len(found.combinations) == 16 and found.fits == 3
    folds = models.search_rows(rows, folds=3, keys=("id",)).cache()
    for c, scores in zip(found.combinations, found.fold_scores):
        for fold, score in enumerate(scores):
            model = fit(folds.where(F.col("fold") != fold), numTrees=6, seed=42)
            held = folds.where(F.col("fold") == fold)
            counts = forests.count_recalls(model, held, [c["numTrees"]], [c["maxDepth"]], [c["minRowsToSplit"]])
            right, wanted = next(iter(counts.values()))
            assert score == pytest.approx(right / wanted, abs=1e-12)
    means = found.mean_scores
    assert found.best == means.index(max(means))
    assert models.grid_table(spark, found).where("is_best").first().combination == found.best


def test_subset_sizes_share_fits():
    assert models._subset_size("sqrt", 35) == models._subset_size("log2", 35) == 6
    assert models._subset_size("sqrt", 100) != models._subset_size("log2", 100)
