import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from ledgerlens.operators import evaluate, features, models, sampling
from ledgerlens.plans import pipelines
from ledgerlens.session import scratch_path
from ledgerlens.sources import files, fixtures
from ledgerlens.sources.schema import FEATURES


@pytest.fixture(scope="module")
def splits_path(spark, sf_small):
    path = scratch_path(spark, "test-splits")
    pipelines.features_and_splits(fixtures.transactions(spark, sf_small), scratch_path(spark, "test-features"), path)
    return path


def test_splits_are_pruned_by_folder(spark, splits_path):
    test = files.load_splits(spark, splits_path, "test")
    assert test.count() == 200
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_importances_and_quality(spark, sf_check):
    table = features.feature_pipeline(fixtures.transactions(spark, sf_check))
    parted = sampling.stratified_split(table)
    train, test = parted.where("split = 'train'").cache(), parted.where("split = 'test'").cache()
    model = models.train_forest(train, trees=20, depth=10)
    assert evaluate.roc_auc(models.score(model, test)).first().roc_auc > 0.85
    ranked = models.feature_importance(spark, model, n=None).collect()
    assert len(ranked) == 35 and sum(r.importance for r in ranked) == pytest.approx(1.0)
    assert {"v17", "v14", "v12"} <= {r.feature for r in ranked[:8]}
    assert models.feature_importance(spark, model).count() == 35


def test_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1, None, 0)], "id bigint, a double, class int")
    with pytest.raises(Exception):
        models.assemble(df, ["a"]).collect()


def test_full_pipeline(spark, splits_path):
    model_path = scratch_path(spark, "test-model")
    result = pipelines.ml_pipeline(
        spark,
        splits_path,
        model_path,
        settings={models.FOREST: {"trees": 5, "depth": 5}, models.BOOSTED: {"rounds": 3, "depth": 3}},
        grid={"numTrees": [3, 5], "maxDepth": [4]},
        folds=3,
    )
    assert [r.name for r in result.metrics.orderBy("position").collect()] == [
        models.LOGREG, models.TREE, models.FOREST, models.BOOSTED, models.TUNED
    ]
    assert result.grid.where("is_best").count() == 1
    assert result.recall_gain_pct is not None
    tables = pipelines.evaluation_run(spark, model_path, splits_path)
    reloaded = tables["roc_auc"].first().roc_auc
    tuned = result.metrics.where(F.col("name") == models.TUNED).first().roc_auc
    assert reloaded == tuned
    assert tables["confusion_matrix"].agg(F.sum("n")).first()[0] == 200
    assert tables["feature_importance"].count() == 35


def test_full_grid_has_72_combinations():
    size = 1
    for values in models.FULL_GRID.values():
        size *= len(values)
    assert size == 72 and models.FULL_DEPTH == 30


def test_registered_search_is_the_whole_grid_on_all_rows(spark, monkeypatch):
    rows = spark.range(600).select("id", (F.col("id") % 2).cast("int").alias("class"), *[F.rand(1).alias(c) for c in FEATURES])
    seen = {}

    def search(kept, size, label, grid, folds, *_):
        seen.update(grid=grid, folds=folds, rows=kept.count(), size=size)
        raise StopIteration

    monkeypatch.setattr(models, "_search", search)
    monkeypatch.setattr(registered, "_train_test", lambda *_: (rows.withColumn("copy_no", F.lit(0)), None))
    with pytest.raises(StopIteration):
        registered.grid_search_forest(spark, "")
    assert seen == {"grid": models.FULL_GRID, "folds": 5, "rows": 600, "size": 35}


def test_registered_search_leaves_out_no_rows(spark, monkeypatch):
    """More rows than a search was once cut to: all of them are searched."""
    rows = spark.range(21_000).select("id", (F.col("id") % 2).cast("int").alias("class"), *[F.lit(0.5).alias(c) for c in FEATURES])
    seen = []

    def search(kept, *_):
        seen.append(kept.count())
        raise StopIteration

    monkeypatch.setattr(models, "_search", search)
    monkeypatch.setattr(registered, "_train_test", lambda *_: (rows.withColumn("copy_no", F.lit(0)), None))
    with pytest.raises(StopIteration):
        registered.grid_search_forest(spark, "")
    assert seen == [21_000]


def test_report_is_written_and_read_back(spark, sf_small):
    table = fixtures.transactions(spark, sf_small)
    root = scratch_path(spark, "test-report")
    sections = pipelines.report_build(
        table, fixtures.scored(spark, sf_small), fixtures.scored_models(spark, sf_small), root, amount_col="amount_scaled"
    )
    assert list(sections) == ["summary", "hourly", "flagged", "models"]
    assert sections["summary"].first().total == 1000
    assert sections["flagged"].count() == 60
    assert sections["models"].where("is_best").first().name == "Tuned"


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("Time," + ",".join(f"V{i}" for i in range(1, 29)) + ",Amount,Class\nx" + ",1" * 30 + "\n")
    with pytest.raises(Exception):
        files.load_raw(spark, str(tmp_path / "raw.csv")).collect()


def test_csv_round_trip_with_nulls(spark, sf_small):
    dirty = fixtures.transactions_dirty(spark, sf_small)
    path = scratch_path(spark, "test-csv")
    files.save(files.transactions_to_raw(dirty), path)
    back = files.raw_to_transactions(files.load_raw(spark, path))
    assert back.exceptAll(dirty).count() == 0 and back.count() == dirty.count() == 1100
    assert len(FEATURES) == 35


def test_kept_rows_are_dealt_without_sorting_a_task(spark, capsys):
    """Dealing rows in turn holds and sorts all rows of a task first; dealing them by their place does not."""
    rows = spark.range(2000).selectExpr("id", "cast(id % 2 as int) as class", "cast(id as double) as x")
    with models.ready_rows(rows, ["x"], "class") as kept:
        sizes = [len(part) for part in kept.rdd.glom().collect()]
        kept.explain()
        assert kept.count() == 2000 and kept.columns == ["features", "class"]
    assert "RoundRobin" not in capsys.readouterr().out
    assert max(sizes) < 2 * 2000 / len(sizes)
