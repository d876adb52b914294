"""Classifiers, tuning and scoring on Spark ML."""

from __future__ import annotations

import math
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..sources.schema import FEATURES
from . import bagging
from .boosting import fit_boosted
from .evaluate import model_metrics
from .forests import PROB, ForestModel, count_recalls, cut_small_nodes
from .sampling import stratified_kfold

# Model names and the tuning grids. Spark caps tree depth at 30, which stands for "no limit".
LOGREG, TREE, FOREST, BOOSTED = "Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting"
TUNED = "Random Forest (Tuned)"
FULL_DEPTH = 30
TASK_ROWS = 50_000
FULL_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [FULL_DEPTH, 10, 20],
    "minRowsToSplit": [2, 5],
    "minInstancesPerNode": [1, 2],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
#: What a combination has where a grid leaves an axis out.
DEFAULTS = {
    "numTrees": 100,
    "maxDepth": FULL_DEPTH,
    "minRowsToSplit": 2,
    "minInstancesPerNode": 1,
    "featureSubsetStrategy": "sqrt",
}
DEMO_GRID = {"numTrees": [100, 200], "maxDepth": [10, FULL_DEPTH], "featureSubsetStrategy": ["sqrt"]}


def assemble(df: DataFrame, features: list[str] = FEATURES, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


@contextmanager
def ready_rows(train: DataFrame, features: list[str], *keep: str):
    """The assembled training rows, kept while models pass over them again and again.

    Every core gets a task, and no task much more than ``TASK_ROWS`` rows.
    """
    rows = _assembler(features).transform(train).select("features", *keep)
    cores = train.sparkSession.sparkContext.defaultParallelism
    # dealt by place: dealing in turn would hold and sort all rows of a task first
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    rows = placed.repartition(max(cores, math.ceil(train.count() / TASK_ROWS)), "_place").drop("_place")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def logreg(n_train: int, max_iter: int = 1000, scale: bool = False, label: str = "class") -> LogisticRegression:
    """L2 with unit strength on the summed loss, i.e. 1/n on Spark's mean loss."""
    return LogisticRegression(
        labelCol=label, maxIter=max_iter, regParam=1.0 / n_train, elasticNetParam=0.0, standardization=scale
    )


def tree(depth: int = 10, seed: int = 42, label: str = "class", **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth, impurity="gini", seed=seed, **params)


def fit_forest(
    rows: DataFrame, size: int, trees: int = 100, depth: int = FULL_DEPTH, seed: int = 42, label: str = "class", **params
) -> ForestModel | RandomForestClassificationModel:
    """A forest of ``rows`` with ``size`` features; settings that only Spark's own trainer knows are left to it."""
    params = {"featureSubsetStrategy": "sqrt", "minInstancesPerNode": 1} | params
    if params.keys() - {"featureSubsetStrategy", "minInstancesPerNode"}:
        params = {"cacheNodeIds": True, "maxMemoryInMB": 1024} | params
        return RandomForestClassifier(
            labelCol=label, numTrees=trees, maxDepth=depth, impurity="gini", seed=seed, **params
        ).fit(rows)
    strategy, least = params["featureSubsetStrategy"], params["minInstancesPerNode"]
    return bagging.fit_forest(rows, label, trees, depth, seed, _subset_size(strategy, size), least, strategy=strategy)


def _fit(rows: DataFrame, name: str, features: list[str], label: str, params: dict) -> PipelineModel:
    if name == BOOSTED:
        fitted = fit_boosted(rows, label, **params)
    elif name == LOGREG:
        fitted = logreg(rows.count(), label=label, **params).fit(rows)
    elif name == FOREST:
        fitted = fit_forest(rows, len(features), label=label, **params)
    else:
        fitted = tree(label=label, **params).fit(rows)
    return PipelineModel(stages=[_assembler(features), fitted])


def train(df: DataFrame, name: str, features: list[str] = FEATURES, label: str = "class", **params) -> PipelineModel:
    """Fit one baseline by name; the model carries its assembler."""
    with ready_rows(df, features, label) as rows:
        return _fit(rows, name, features, label, params)


def train_logreg(df: DataFrame, features: list[str] = FEATURES, label: str = "class", **params) -> PipelineModel:
    return train(df, LOGREG, features, label, **params)


def train_tree(df: DataFrame, features: list[str] = FEATURES, label: str = "class", **params) -> PipelineModel:
    return train(df, TREE, features, label, **params)


def train_forest(df: DataFrame, features: list[str] = FEATURES, label: str = "class", **params) -> PipelineModel:
    return train(df, FOREST, features, label, **params)


def train_gbt(df: DataFrame, features: list[str] = FEATURES, label: str = "class", **params) -> PipelineModel:
    """Boosted trees with the regularised second-order objective, see ``boosting.fit_boosted``."""
    return train(df, BOOSTED, features, label, **params)


def _spread(df: DataFrame, *models: Model) -> DataFrame:
    """``df`` over all cores if any of ``models`` is of many trees: rows that fit one file are long work for these.

    A stored forest spreads its rows itself.
    """
    if not any(not isinstance(m, ForestModel) and hasattr(m, "trees") for m in models):
        return df
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def score(model: Model, df: DataFrame, label: str = "class") -> DataFrame:
    """``id, label, prob, prediction``; ``prob`` is P(class 1)."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if isinstance(last, ForestModel):
        rows = PipelineModel(model.stages[:-1]).transform(df) if isinstance(model, PipelineModel) else df
        rows = rows.select("id", F.col(label).cast("int").alias("label"), last.getFeaturesCol())
        return last.scored(rows, ["id", "label"]).withColumn("prediction", (F.col(PROB) > 0.5).cast("int"))
    return model.transform(_spread(df, last)).select(
        "id",
        F.col(label).cast("int").alias("label"),
        vector_to_array("probability")[1].alias("prob"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def train_all(
    df: DataFrame,
    test: DataFrame,
    features: list[str] = FEATURES,
    label: str = "class",
    settings: dict[str, dict] | None = None,
    kept: DataFrame | None = None,
    parallelism: int = 4,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit the four baselines side by side; returns the models and the long scored table of the test rows.

    ``kept`` are rows of ``ready_rows``, if the caller has them already.
    """
    settings = settings or {}
    if kept is None:
        with ready_rows(df, features, label) as rows:
            return train_all(df, test, features, label, settings, rows, parallelism)
    names = (LOGREG, TREE, FOREST, BOOSTED)

    def run(name: str) -> PipelineModel:
        return _fit(kept, name, features, label, settings.get(name, {}))

    with ThreadPool(max(1, min(parallelism, len(names)))) as pool:
        models = dict(zip(names, pool.map(inheritable_thread_target(kept.sparkSession)(run), names)))
    return models, score_all(models, test, label)


def score_all(models: dict[str, PipelineModel], test: DataFrame, label: str = "class") -> DataFrame:
    """The long scored table of several models (which share one assembler), in one pass over the rows."""
    rows, cells = _spread(test, *[model.stages[-1] for model in models.values()]), []
    for i, (name, model) in enumerate(models.items(), start=1):
        prob, prediction = f"_prob{i}", f"_pred{i}"
        if i == 1:
            rows = model.stages[0].transform(rows).select("id", F.col(label).cast("int").alias("label"), "features")
        if isinstance(model.stages[-1], ForestModel):
            rows = model.stages[-1].scored(rows, rows.columns).withColumnRenamed(PROB, prob)
            rows = rows.withColumn(prediction, (F.col(prob) > 0.5).cast("int"))
        else:
            classifier = model.stages[-1].copy()
            classifier.setRawPredictionCol("_raw").setProbabilityCol("_probability").setPredictionCol("_prediction")
            rows = classifier.transform(rows).withColumns(
                {prob: vector_to_array("_probability")[1], prediction: F.col("_prediction").cast("int")}
            )
            rows = rows.drop("_raw", "_probability", "_prediction")
        told = {"model": F.lit(name), "position": F.lit(i), "prob": F.col(prob), "prediction": F.col(prediction)}
        cells.append(F.struct(*[column.alias(c) for c, column in told.items()]))
    long = rows.select("id", "label", F.explode(F.array(*cells)).alias("m"))
    return long.select("m.model", "m.position", "id", "label", "m.prob", "m.prediction")


def baseline_metrics(scored: DataFrame, digits: int | None = None) -> DataFrame:
    return model_metrics(scored, digits)


@dataclass
class ForestSearch:
    """Every combination with its recall in each fold (and their mean), which is best, and the refitted best model."""

    combinations: list[dict]
    fold_scores: list[list[float]]
    best: int
    fits: int  # forests that were grown for all the scores
    best_model: Model

    @property
    def mean_scores(self) -> list[float]:
        return [sum(s) / len(s) for s in self.fold_scores]


def _subset_size(strategy: str, n: int) -> int:
    """How many of ``n`` features a split may choose from."""
    known = {"sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "all": n, "onethird": math.ceil(n / 3)}
    return known[strategy]


def search_rows(
    df: DataFrame, label: str = "class", folds: int = 5, seed: int = 42, keys: tuple[str, ...] = ("id", "copy_no")
) -> DataFrame:
    """``df`` with the fold of each row."""
    return stratified_kfold(df, label, folds, seed, keys)


def _search(rows: DataFrame, size: int, label: str, grid: dict, folds: int, seed: int, parallelism: int, params: dict):
    """(combinations, scores of each fold, number of fits) over kept rows (features, label, fold).

    One deep forest is grown for each fold and pair of least leaf size and number of features to choose from; the other
    axes are read from it.
    """
    axes = {name: grid.get(name, [value]) for name, value in DEFAULTS.items()}
    order = [*grid, *[name for name in axes if name not in grid]]
    combinations = [dict(zip(order, values)) for values in product(*[axes[name] for name in order])]
    kinds = {(c["minInstancesPerNode"], _subset_size(c["featureSubsetStrategy"], size)) for c in combinations}
    names = {_subset_size(s, size): s for s in axes["featureSubsetStrategy"]}
    jobs = [(fold, *kind) for fold in range(folds) for kind in sorted(kinds)]

    def run(job: tuple[int, int, int]):
        fold, leaf, subset = job
        grown = fit_forest(
            rows.where(F.col("fold") != fold), size, max(axes["numTrees"]), max(axes["maxDepth"]), seed, label,
            minInstancesPerNode=leaf, featureSubsetStrategy=names[subset], **params,
        )
        held = rows.where(F.col("fold") == fold)
        counts = count_recalls(grown, held, axes["numTrees"], axes["maxDepth"], axes["minRowsToSplit"], label)
        if isinstance(grown, ForestModel):
            grown.discard(rows.sparkSession)
        return counts

    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        found = dict(zip(jobs, pool.map(inheritable_thread_target(rows.sparkSession)(run), jobs)))

    def recall(c: dict, fold: int) -> float:
        counts = found[fold, c["minInstancesPerNode"], _subset_size(c["featureSubsetStrategy"], size)]
        right, wanted = counts.get((c["numTrees"], c["maxDepth"], c["minRowsToSplit"]), (0, 0))
        return right / wanted if wanted else 0.0

    return combinations, [[recall(c, fold) for fold in range(folds)] for c in combinations], len(jobs)


def _refit(rows: DataFrame, size: int, best: dict, label: str, seed: int, params: dict) -> Model:
    """The forest of one combination on all kept rows."""
    fitted = fit_forest(
        rows, size, best["numTrees"], best["maxDepth"], seed, label, minInstancesPerNode=best["minInstancesPerNode"],
        featureSubsetStrategy=best["featureSubsetStrategy"], **params,
    )
    if best["minRowsToSplit"] <= 2:
        return fitted
    return cut_small_nodes(rows.sparkSession, fitted, best["minRowsToSplit"])


def grid_search_forest(
    df: DataFrame,
    features: list[str] = FEATURES,
    label: str = "class",
    grid: dict[str, list] = FULL_GRID,
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    keys: tuple[str, ...] = ("id", "copy_no"),
    kept: DataFrame | None = None,
    **params,
) -> ForestSearch:
    """Cross-validated grid over the forest, scored on the recall of class 1; the best is refitted on all rows.

    The whole grid needs one deep forest per fold and least leaf size (``sqrt`` and ``log2`` of 35 features are 6 each, so they
    share it). Of equal means the first combination is best. Search and refit use every row of ``df``. ``kept`` are
    rows of ``ready_rows`` over ``search_rows``, if the caller has them already.
    """

    def run(rows: DataFrame) -> ForestSearch:
        combinations, scores, fits = _search(rows, len(features), label, grid, folds, seed, parallelism, params)
        means = [sum(s) / len(s) for s in scores]
        best = means.index(max(means))
        again = _refit(rows, len(features), combinations[best], label, seed, params)
        return ForestSearch(combinations, scores, best, fits, again)

    if kept is not None:
        return run(kept)
    with ready_rows(search_rows(df, label, folds, seed, keys), features, label, "fold") as rows:
        return run(rows)


def best_pipeline(search: ForestSearch, features: list[str] = FEATURES) -> PipelineModel:
    """The refitted best model behind the same assembler as the baselines."""
    return PipelineModel(stages=[_assembler(features), search.best_model])


def grid_table(spark: SparkSession, search: ForestSearch) -> DataFrame:
    """One row per combination with its mean score; the best one is flagged."""
    rows = []
    for i, (params, value) in enumerate(zip(search.combinations, search.mean_scores)):
        text = ", ".join(f"{name}={value}" for name, value in sorted(params.items()))
        rows.append((i, text, float(value), i == search.best))
    return spark.createDataFrame(rows, "combination int, params string, mean_recall double, is_best boolean")


def feature_importance(
    spark: SparkSession, model: PipelineModel, names: list[str] = FEATURES, n: int | None = None
) -> DataFrame:
    """``feature, importance``, largest first; all of them, or the first ``n``."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(names, (float(w) for w in weights)), key=lambda r: -r[1])
    return spark.createDataFrame(rows if n is None else rows[:n], "feature string, importance double")
