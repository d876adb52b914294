"""The forest grown in few jobs against its own definition, whole and in parts."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlens.operators import bagging, forests, models


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.random((3000, 4)), 2)
    x[:, 3] = x[:, 3] > 0.99  # nearly constant
    label = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.1, 3000)) > 0.8).astype(int)
    rows = [(i, int(y), *map(float, v)) for i, (v, y) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "id long, class int, a double, b double, c double, d double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df).repartition(3, "id").cache(), x, label


def _drawn(flat, x, y, weight):
    """Every node's drawn rows of (both classes, class 1), by a walk of the rows through the tree."""
    out = {}
    stack = [(int(flat.root[0]), np.arange(len(x)))]
    while stack:
        node, at = stack.pop()
        out[node] = (weight[at].sum(), weight[at][y[at] == 1].sum())
        if flat.left[node] != node:
            goes = x[at, flat.feature[node]] <= flat.threshold[node]
            stack += [(int(flat.left[node]), at[goes]), (int(flat.right[node]), at[~goes])]
    return out


@pytest.mark.parametrize("local_rows", [None, 200])
def test_nodes_hold_the_drawn_rows(spark, table, local_rows, monkeypatch):
    """With and without nodes that are split over all rows."""
    rows, _, _ = table
    monkeypatch.setattr(bagging, "BLOCK", 10_000)
    model = bagging.fit_forest(rows, "class", 1, 30, 5, 4, 3, local_rows)
    assert model.getNumTrees == 1 and model.getOrDefault("maxDepth") == 30
    flat = forests.flatten(spark, model)
    edges = bagging.forest_edges(rows)
    blocks = bagging._blocks(rows, edges, "class").collect()
    assert len(blocks) == 3
    bins = np.concatenate([np.frombuffer(b["bins"], np.uint8).reshape(b["n"], -1) for b in blocks])
    y = np.concatenate([np.frombuffer(b["label"], np.uint8) for b in blocks])
    weight = np.concatenate([bagging.draws(5, 0, b["block"], b["n"]) for b in blocks]).astype(int)
    x = np.column_stack([np.append(e, np.inf)[bins[:, i]] for i, e in enumerate(edges)])
    drawn = _drawn(flat, x, y, weight)
    assert len(drawn) == len(flat.left)  # each node is reached, and numbered once
    for node, (n, ones) in drawn.items():
        assert (flat.rows[node], flat.share[node]) == (n, pytest.approx(ones / n)) and n >= 3


def test_parts_do_not_change_what_is_split_over_all_rows(spark, table):
    """All features may be chosen, so a tree is the same however its nodes are divided between jobs and tasks."""
    rows, x, _ = table
    whole, parted = (bagging.fit_forest(rows, "class", 3, 9, 5, 4, 1, n) for n in (None, 150))
    flat = [forests.flatten(spark, m) for m in (whole, parted)]
    votes = [forests.nested_votes(f, x, [1, 2, 3], [2, 5, 9], [2, 20]) for f in flat]
    for key in votes[0]:
        assert votes[0][key] == pytest.approx(votes[1][key])
    assert whole.featureImportances.toArray() == pytest.approx(parted.featureImportances.toArray())


def test_jobs_do_not_grow_with_the_depth(spark, table, monkeypatch):
    """A deep forest of small nodes takes no pass over all rows for each level."""
    rows, _, _ = table
    passes = []
    level = bagging._level
    monkeypatch.setattr(bagging, "_level", lambda *a: passes.append(1) or level(*a))
    model = models.fit_forest(rows, 4, trees=3, depth=30)
    assert not passes and max(t.depth for t in model.trees) > 8
    bagging.fit_forest(rows, "class", 3, 30, 42, 2, 1, 1000)
    assert 1 <= len(passes) <= 6


def test_one_class_and_constant_features(spark):
    df = spark.range(50).select(F.lit(0).alias("class"), F.lit(1.0).alias("a"), F.col("id").cast("double").alias("b"))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = models.fit_forest(rows, 2, trees=2)
    assert model.totalNumNodes == 2
    mixed = VectorAssembler(inputCols=["a"], outputCol="features").transform(df.withColumn("class", (F.col("b") > 24).cast("int")))
    model = models.fit_forest(mixed, 1, trees=2)
    assert model.totalNumNodes == 2
    assert model.transform(mixed).where(F.isnan("prediction")).isEmpty()


def test_few_files_are_scored_on_all_cores(spark, table):
    """One file of rows and many trees: the rows are spread before they are scored."""
    rows, _, _ = table
    model = models.train_forest(rows.drop("features"), features=list("abcd"), trees=2, depth=3)
    one = rows.drop("features").coalesce(1)
    assert models.score(model, one).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert models.score(model, one).count() == 3000


def test_forest_stays_in_its_table(spark, table, tmp_path):
    """No model object holds the trees: rows meet them in tasks, whatever the rows' partitions, also when read back."""
    rows, x, _ = table
    model = models.fit_forest(rows, 4, trees=23, depth=12)
    assert isinstance(model, forests.ForestModel) and not hasattr(model, "_java_obj")
    told = model.transform(rows.withColumn("name", F.when(F.col("id") % 2 == 0, F.concat(F.lit("n"), "id"))))
    got = told.orderBy("id").collect()
    assert len(got) == 3000 and got[0].name == "n0" and got[1].name is None and (got[7].features.toArray() == x[7]).all()
    flat = forests.flatten(spark, model)
    want = forests.nested_votes(flat, x, [23], [12], [0])[23, 12, 0]
    assert [r.probability[1] * 23 for r in got] == pytest.approx(list(want))
    assert [r.prediction for r in got] == [float(r.probability[1] > 0.5) for r in got]
    assert model.totalNumNodes == len(flat.left) and len(model.trees) == 23 and max(t.depth for t in model.trees) <= 12
    model.write().overwrite().save(str(tmp_path / "m"))
    back = forests.ForestModel.load(str(tmp_path / "m"))
    again = [r.probability[1] for r in back.transform(rows.repartition(7)).orderBy("id").select("probability").collect()]
    assert again == [r.probability[1] for r in got]
    assert (back.featureImportances.toArray() == model.featureImportances.toArray()).all()


def test_trees_sent_in_turns_are_the_same(spark, table, monkeypatch):
    rows, _, _ = table
    told = lambda: sorted(tuple(r) for r in bagging.fit_forest(rows, "class", 3, 9, 5, 2, 1, 500).nodes(spark).collect())
    whole = told()
    monkeypatch.setattr(bagging, "SENT_BYTES", 20_000)
    assert told() == whole and len(whole) == 3
