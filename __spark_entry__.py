"""Entry points: the flagship query, all registered queries, and their DuckDB counterparts."""

from __future__ import annotations

import sys
from collections.abc import Callable
from importlib import import_module
from importlib.util import find_spec
from pathlib import Path

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries  # noqa: E402
from ledgerlens.functions.numeric import half_up  # noqa: E402
from ledgerlens.operators import (  # noqa: E402
    clean,
    dashboard,
    evaluate,
    explore,
    features,
    models,
    neighbours,
    profile,
    reports,
    sampling,
)
from ledgerlens.plans import pipelines  # noqa: E402
from ledgerlens.session import materialize, scratch_path  # noqa: E402
from ledgerlens.sources import files, fixtures  # noqa: E402
from ledgerlens.sources.schema import FEATURED_COLUMNS, FEATURES, V_COLUMNS  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The whole grid on all train rows: one forest of 300 trees for each fold and leaf size; the best combination is fitted
# again.
GRID = {"grid": models.FULL_GRID, "folds": 5, "parallelism": 4}


# ---------------------------------------------------------------- inputs
def _full(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.transactions(spark, sf)


def _narrow(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.transactions(spark, sf, vectors=False)


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.transactions_dirty(spark, sf)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.scored(spark, sf)


def _scored_models(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.scored_models(spark, sf)


def _featured(spark: SparkSession, sf: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The feature table, with the numbers fitted on the narrow columns."""
    stats = features.fit_feature_stats(_narrow(spark, sf))
    return features.feature_pipeline(_full(spark, sf), stats, keep)


def _featured_narrow(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table without the V columns."""
    table = _narrow(spark, sf)
    return features.feature_pipeline(table, features.fit_feature_stats(table), keep=("amount",))


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: half_up(F.col(c), digits) for c in cols})


def _stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table as a stage of its own: splitting passes over it several times."""
    return materialize(_featured(spark, sf), "featured")


def _splits(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.resampled_splits(_stored_features(spark, sf))


def _stored_splits(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "splits")
    files.save_splits(_splits(spark, sf), path)
    return path


def _train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = _stored_splits(spark, sf)
    return files.load_splits(spark, path, "train"), files.load_splits(spark, path, "test")


# ---------------------------------------------------------------- sources and sinks
def src_csv_raw(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    files.save(files.transactions_to_raw(_full(spark, sf)), path)
    return files.raw_to_transactions(files.load_raw(spark, path))


def src_table(spark: SparkSession, sf: str) -> DataFrame:
    files.register_table(features.with_hour(_narrow(spark, sf)), "transactions")
    return spark.sql("SELECT id, time_seconds, amount, class, hour_of_day FROM transactions")


def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    flagged = reports.q10_audit_flags(_narrow(spark, sf))
    path = scratch_path(spark, "audit") + "/flagged_for_audit.csv"
    files.save(flagged, path)
    return files.load_raw(spark, path, flagged.schema)


def splits_store(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parted")
    files.save_splits(sampling.stratified_split(_narrow(spark, sf)), path)
    return files.load_splits(spark, path, "test").select("id", "class", "split")


def model_store(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of a model and of its reloaded copy on the same rows, over the whole table."""
    table = _featured(spark, sf)
    model = models.train_tree(table)
    path = scratch_path(spark, "model")
    files.save_model(model, path)
    both = models.score_all({"before": model, "after": files.load_model(path)}, table)
    pairs = both.groupBy("id").agg(F.min("prob").alias("low"), F.max("prob").alias("high"))
    return pairs.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("low") == F.col("high")).alias("equal_rows"))


def report_store(spark: SparkSession, sf: str) -> DataFrame:
    table = _featured_narrow(spark, sf)
    paths = files.save_report(
        {"hourly": dashboard.report_hourly(table), "flagged": dashboard.report_flagged(table)},
        scratch_path(spark, "report"),
    )
    sections = files.load_report(spark, paths)
    return _section_sizes(sections)


def _section_sizes(sections: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, table in sections.items():
        row = table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("section"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- cleaning and features
def clean_run(spark: SparkSession, sf: str) -> DataFrame:
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "cleaned")
    files.save(files.transactions_to_raw(_dirty(spark, sf)), raw, compression="gzip")
    return _rounded(pipelines.clean_pipeline(spark, raw, out, compression="gzip"), "amount_scaled")


def _feature_columns(df: DataFrame) -> DataFrame:
    return _rounded(df, "amount_scaled", "amount_zscore").select(FEATURED_COLUMNS)


def feat_interactions(spark: SparkSession, sf: str) -> DataFrame:
    return features.feat_interactions(_full(spark, sf)).select("id", "v1_v3_interact", "v4_v11_interact")


def feat_clip(spark: SparkSession, sf: str) -> DataFrame:
    table = features.feat_clip(features.feat_amount_zscore(_narrow(spark, sf)), lo=-0.5, hi=1.5)
    return _rounded(table.select("id", "amount_zscore"), "amount_zscore")


def smote_knn_hashed(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the exact neighbours the hashed search is held against, and whether it finds nine in ten."""
    train = sampling.stratified_split(_stored_features(spark, sf)).where("split = 'train'")
    exact = materialize(sampling.smote_knn(train), "exact-neighbours")
    told = neighbours.neighbour_recall(exact, sampling.smote_knn(train, method="lsh"))
    return told.select("wanted", (F.col("recall") >= 0.9).alias("recall_reached"))


# ---------------------------------------------------------------- training
def _settings(model) -> dict:
    """What was fitted: number of trees, deepest tree, and the settings behind them."""
    fitted = model.stages[-1]
    trees = list(getattr(fitted, "trees", [])) or ([fitted] if hasattr(fitted, "depth") else [])
    return {
        "n_trees": len(trees),
        "depth_setting": fitted.getOrDefault("maxDepth") if trees else 0,
        "iterations": fitted.getOrDefault("maxIter") if fitted.hasParam("maxIter") else 0,
        "deep": max((t.depth for t in trees), default=0),
    }


def _flat_loss(model, rows: DataFrame) -> bool:
    """Whether the gradient of the regularised loss is near zero at the fitted coefficients."""
    fitted = model.stages[-1]
    assembled = model.stages[0].transform(rows)
    error = vector_to_array("probability")[1] - F.col("class")
    scored = fitted.transform(assembled).select(error.alias("e"), vector_to_array("features").alias("x"))
    size = len(FEATURES)
    row = scored.agg(F.avg("e"), *[F.avg(F.col("e") * F.col("x")[i]) for i in range(size)], F.count(F.lit(1))).first()
    strength = 1.0 / row[size + 1]
    weights = fitted.coefficients.toArray()
    gradient = [row[0], *[row[i + 1] + strength * weights[i] for i in range(size)]]
    return max(map(abs, gradient)) < 2e-3


def _tree_rule(node, names: list[str]) -> str:
    """A fitted tree written out as one SQL expression for its prediction."""
    if node.getClass().getSimpleName() == "LeafNode":
        return str(node.prediction())
    split = node.split()
    rule = f"{names[split.featureIndex()]} <= {split.threshold()!r}D"
    return f"if({rule}, {_tree_rule(node.leftChild(), names)}, {_tree_rule(node.rightChild(), names)})"


def _same_as_rule(model, rows: DataFrame) -> bool:
    """Whether the tree predicts what its written-out rules say, on every row."""
    rule = F.expr(_tree_rule(model.stages[-1]._call_java("rootNode"), FEATURES))
    told = model.transform(rows).select(F.col("prediction").alias("p"), rule.alias("r"))
    return told.where("p <> r").isEmpty()


def _quality(spark: SparkSession, model, train: DataFrame, test: DataFrame, name: str, floor: float = 0.85) -> DataFrame:
    """Row counts, what was fitted, and invariants on the test split, in one row."""
    scored = materialize(models.score(model, test), "scored")
    counted = scored.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sum("label").cast("bigint").alias("test_fraud"),
        F.count_if(F.col("prob").between(0.0, 1.0)).alias("valid_prob"),
    )
    good = evaluate.roc_auc(scored).select(F.col("roc_auc") > floor).scalar()
    told = _settings(model)
    if name == models.LOGREG:
        right = _flat_loss(model, train)
    elif name == models.TREE:
        right = told["deep"] == 10 and _same_as_rule(model, test)
    else:
        right = told["deep"] >= min(6, told["depth_setting"])
    return counted.select(
        F.lit(name).alias("name"),
        "*",
        F.lit(told["n_trees"]).alias("n_trees"),
        F.lit(told["depth_setting"]).alias("depth_setting"),
        F.lit(told["iterations"]).alias("iterations"),
        F.lit(right).alias("fitted_right"),
    ).withColumn("auc_above_floor", good)


def _compared(scored: DataFrame, metrics: DataFrame) -> DataFrame:
    """Scored rows and invariants per model."""
    counted = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_test"), F.sum("label").cast("bigint").alias("test_fraud")
    )
    good = metrics.select("name", "position", (F.col("roc_auc") > 0.85).alias("auc_above_floor"))
    return good.join(F.broadcast(counted), F.col("name") == F.col("model")).drop("model")


def _trained(trainer, name: str, **params) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        train, test = _train_test(spark, sf)
        return _quality(spark, trainer(train, **params), train, test, name)

    return run


def assemble(spark: SparkSession, sf: str) -> DataFrame:
    vectors = models.assemble(_featured(spark, sf)).select(vector_to_array("features").alias("x"))
    return vectors.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size("x")).alias("n_features"),
        half_up(F.sum(F.col("x")[0]), 4).alias("sum_first"),
        F.sum(F.col("x")[len(V_COLUMNS) + 1]).cast("bigint").alias("sum_hours"),
    )


def score(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the whole table by a tree of the original rows."""
    table = _stored_features(spark, sf)
    model = models.train_tree(table)
    rule = F.expr(_tree_rule(model.stages[-1]._call_java("rootNode"), FEATURES)).cast("int").alias("rule")
    scored = models.score(model, table).join(table.select("id", rule), "id")
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("prob").between(0.0, 1.0)).alias("valid_prob"),
        F.count_if((F.col("prob") > 0.5) == (F.col("prediction") == 1)).alias("consistent_rows"),
        F.count_if(F.col("prediction") == F.col("rule")).alias("rule_rows"),
    )


def train_all(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _train_test(spark, sf)
    fitted, scored = models.train_all(train, test)
    scored = materialize(scored, "scored")
    table = _compared(scored, models.baseline_metrics(scored))
    trees = [(name, _settings(model)["n_trees"]) for name, model in fitted.items()]
    return table.join(F.broadcast(spark.createDataFrame(trees, "name string, n_trees int")), "name")


def grid_search_forest(spark: SparkSession, sf: str) -> DataFrame:
    """``is_best`` must be where the recomputed recalls are highest."""
    train, _ = _train_test(spark, sf)
    search = models.grid_search_forest(train, **GRID)
    table = models.grid_table(spark, search).withColumn("n_train", F.lit(train.count()).cast("bigint"))
    table = table.withColumn("recall_in_range", F.col("mean_recall").between(0.5, 1.0))
    best = table.agg(F.max("mean_recall")).scalar()
    table = table.withColumn("best_is_highest", ~F.col("is_best") | (F.col("mean_recall") == best))
    return table.select("combination", "params", "n_train", "recall_in_range", "best_is_highest")


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    rows = _featured(spark, sf)
    model = models.train_forest(rows)
    ranked = models.feature_importance(spark, model)
    table = ranked.withColumn("n_rows", F.lit(rows.count()).cast("bigint"))
    return table.agg(
        F.max("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_features"),
        half_up(F.sum("importance"), 6).alias("total_importance"),
        (F.max(F.when(F.col("feature") == "v17", F.col("importance"))) > 0.01).alias("signal_found"),
        F.lit(_settings(model)["n_trees"]).alias("n_trees"),
    )


def ml_run(spark: SparkSession, sf: str) -> DataFrame:
    splits, model = _stored_splits(spark, sf), scratch_path(spark, "best")
    result = pipelines.ml_pipeline(spark, splits, model, **GRID)
    table = _compared(result.scored, result.metrics)
    return table.withColumns(
        {
            "n_importances": F.lit(result.importance.count()).cast("bigint"),
            "n_combinations": F.lit(result.grid.count()).cast("bigint"),
        }
    )


def evaluation_run(spark: SparkSession, sf: str) -> DataFrame:
    splits, model = _stored_splits(spark, sf), scratch_path(spark, "best")
    train = files.load_splits(spark, splits, "train")
    files.save_model(models.train_forest(train), model)
    tables = pipelines.evaluation_run(spark, model, splits)
    wanted = (
        "classification_report", "confusion_matrix", "roc_auc", "average_precision", "no_skill_baseline",
        "feature_importance",
    )
    sizes = _section_sizes({name: tables[name] for name in wanted})
    return sizes.withColumn("test_rows", tables["confusion_matrix"].agg(F.sum("n")).scalar())


def report_build(spark: SparkSession, sf: str) -> DataFrame:
    sections = pipelines.report_build(
        _narrow(spark, sf), _scored(spark, sf), _scored_models(spark, sf), scratch_path(spark, "dashboard")
    )
    return _section_sizes(sections)


def chain_run(spark: SparkSession, sf: str) -> DataFrame:
    """Raw CSV, cleaning, features, splits, over-sampling, training and evaluation, each on what the one before stored.

    The rows are the stored splits' original rows; the counts at the end come from the evaluation of a tree trained on
    them.
    """
    raw, cleaned, featured, splits, model = (scratch_path(spark, n) for n in ("raw", "cleaned", "features", "splits", "model"))
    files.save(files.transactions_to_raw(_complete_dirty(spark, sf)), raw, compression="gzip")
    table = pipelines.clean_pipeline(spark, raw, cleaned, compression="gzip")
    stored = pipelines.features_and_splits(table, featured, splits)
    train = files.load_splits(spark, splits, "train")
    files.save_model(models.train_tree(train), model)
    tables = pipelines.evaluation_run(spark, model, splits)
    good = tables["roc_auc"].select(F.col("roc_auc") > 0.85).scalar()
    tested = tables["confusion_matrix"].agg(F.sum("n").alias("n")).scalar()
    rows = stored.where("NOT is_synthetic").select("id", "class", "split", "hour_of_day", "high_value_flag", "amount_scaled")
    return _rounded(rows, "amount_scaled").withColumns({"test_rows": tested, "auc_above_floor": good})


def _complete_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows with repeats but without missing amounts, which the models do not take."""
    table = _full(spark, sf)
    copies = F.when(F.col("id") % 10 == 0, 2).otherwise(1)
    return table.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy", "id")


# ---------------------------------------------------------------- variants
def confusion_square(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion_square(_scored(spark, sf))


def report_summary_formatted(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.report_summary_formatted(dashboard.report_summary(_narrow(spark, sf), _scored(spark, sf)))


def report_summary_scaled(spark: SparkSession, sf: str) -> DataFrame:
    """The summary of a table that has only the scaled amount."""
    table = _featured_narrow(spark, sf).drop("amount")
    return dashboard.report_summary(table, _scored(spark, sf), amount_col="amount_scaled")


def removed_rows(spark: SparkSession, sf: str) -> DataFrame:
    dirty = materialize(_dirty(spark, sf), "dirty")
    return clean.removed_rows(dirty, clean.dedup_rows(dirty))


def dedup_lowest_id(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated (time, amount, class): the row with the smallest id stays."""
    table = _narrow(spark, sf).withColumn("amount", F.round("amount", -1)).withColumn(
        "time_seconds", F.floor(F.col("time_seconds") / 7200)
    )
    return clean.dedup_rows(table, id_col="id").select("id", "time_seconds", "amount", "class")


def split_by_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(_narrow(spark, sf), exact=False).select("id", "class", "split")


def feature_run_train_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Features whose scaler and threshold are fitted on the train rows alone."""
    table = sampling.stratified_split(_narrow(spark, sf))
    out = features.feature_pipeline(table, fit_on=table.where("split = 'train'"))
    return _rounded(out.select("id", "split", "amount_scaled", "high_value_flag"), "amount_scaled")


# ---------------------------------------------------------------- registration
def entry(spark: SparkSession) -> DataFrame:
    return reports.q05_fraud_rate_by_hour(_narrow(spark, "/root/testdata/sf0.001"))


def _llm_modules() -> list:
    """The modules that add the training-data queries; none if the subpackage is not there."""
    if any(find_spec(name) is None for name in ("ledgerlens.llm", "corpus_pipeline")):
        return []
    try:
        return [import_module("ledgerlens.llm.queries"), import_module("corpus_pipeline")]
    except ModuleNotFoundError as missing:
        if missing.name and missing.name.startswith("ledgerlens.llm"):  # an empty folder was left
            return []
        raise


def queries() -> dict[str, Query]:
    found = _core_queries()
    for module in _llm_modules():
        found.update(module.all_queries())
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.all_queries()
    for module in _llm_modules():
        found.update(module.all_oracles())
    return found


def _core_queries() -> dict[str, Query]:
    def on(source: Query, operator: Callable[..., DataFrame], **params) -> Query:
        return lambda spark, sf: operator(source(spark, sf), **params)

    smote_columns = ["amount_scaled", "amount_zscore", "v1_v3_interact", "v4_v11_interact", *V_COLUMNS]
    return {
        "src_csv_raw": src_csv_raw,
        "src_table": src_table,
        "sink_csv": sink_csv,
        "splits_store": splits_store,
        "model_store": model_store,
        "report_store": report_store,
        "profile_shape": on(_dirty, profile.profile_shape),
        "profile_nulls": on(_dirty, profile.profile_nulls),
        "profile_duplicates": on(_dirty, profile.profile_duplicates),
        "profile_describe": on(_narrow, profile.profile_describe),
        "fraud_rate": on(_narrow, profile.fraud_rate),
        "class_counts": on(_narrow, profile.class_counts),
        "head_preview": on(_full, profile.head_preview),
        "dedup_rows": on(_dirty, clean.dedup_rows),
        "standard_scale": lambda s, d: _rounded(
            clean.standard_scale(_narrow(s, d)).select("id", "amount_scaled"), "amount_scaled"
        ),
        "drop_columns": lambda s, d: clean.drop_columns(_full(s, d), "amount", "time_seconds", "not_there"),
        "reorder_label_last": lambda s, d: clean.reorder_label_last(
            _narrow(s, d).select("class", "id", "time_seconds", "amount")
        ),
        "clean_run": clean_run,
        "filter_class": on(_full, clean.filter_class, value=1),
        "feat_hour_of_day": lambda s, d: features.feat_hour_of_day(_narrow(s, d)).select("id", "hour_of_day"),
        "feat_high_risk_hour": lambda s, d: features.feat_high_risk_hour(
            features.feat_hour_of_day(_narrow(s, d))
        ).select("id", "hour_of_day", "high_risk_hour"),
        "feat_amount_zscore": lambda s, d: _rounded(
            features.feat_amount_zscore(_narrow(s, d)).select("id", "amount_zscore"), "amount_zscore"
        ),
        "quantile_threshold": lambda s, d: _rounded(features.quantile_threshold(_narrow(s, d)), "threshold", digits=9),
        "feat_high_value_flag": lambda s, d: features.feat_high_value_flag(_narrow(s, d)).select(
            "id", "amount", "high_value_flag"
        ),
        "feat_interactions": feat_interactions,
        "feat_log_amount": lambda s, d: _rounded(
            features.feat_log_amount(_narrow(s, d)).select("id", "log_amount"), "log_amount"
        ),
        "feat_clip": feat_clip,
        "feature_run": lambda s, d: _feature_columns(_featured(s, d)),
        "q01_class_distribution": on(_narrow, reports.q01_class_distribution),
        "q02_top_fraud": on(_narrow, reports.q02_top_fraud),
        "q03_amount_by_class": on(_narrow, reports.q03_amount_by_class),
        "q04_fraud_by_hour": on(_narrow, reports.q04_fraud_by_hour),
        "q05_fraud_rate_by_hour": on(_narrow, reports.q05_fraud_rate_by_hour),
        "q06_fraud_above_p95": on(_narrow, reports.q06_fraud_above_p95),
        "q07_time_blocks": on(_narrow, reports.q07_time_blocks),
        "q08_threshold_coverage": on(_narrow, reports.q08_threshold_coverage),
        "q08_threshold_coverage_join": on(_narrow, reports.q08_threshold_coverage_join),
        "q09_fraud_streaks": on(_narrow, reports.q09_fraud_streaks),
        "q10_audit_flags": on(_narrow, reports.q10_audit_flags),
        "q11_hour_range_share": on(_narrow, reports.q11_hour_range_share),
        "eda_amount_stats_by_class": on(_narrow, explore.eda_amount_stats_by_class),
        "eda_amount_histogram": on(_narrow, explore.eda_amount_histogram),
        "eda_hourly_volume": on(_narrow, explore.eda_hourly_volume),
        "eda_mean_hourly_rate": on(_narrow, explore.eda_mean_hourly_rate),
        "eda_peak_hour": on(_narrow, explore.eda_peak_hour),
        "eda_correlation_matrix": on(_full, explore.eda_correlation_matrix),
        "eda_top_correlated": on(_full, explore.eda_top_correlated),
        "eda_box_stats": on(_narrow, explore.eda_box_stats),
        "eda_box_stats_log": on(_narrow, explore.eda_box_stats_log),
        "fe_fraud_by_hour": on(_narrow, explore.fe_fraud_by_hour),
        "fe_fraud_by_risk_flag": on(_featured_narrow, explore.fe_fraud_by_risk_flag),
        "fe_zscore_histogram": on(_featured_narrow, explore.fe_zscore_histogram),
        "fe_high_value_crosstab": on(_featured_narrow, explore.fe_high_value_crosstab),
        "fe_interaction_corr": on(_featured, explore.fe_interaction_corr),
        "fe_feature_corr_ranking": on(_featured, explore.fe_feature_corr_ranking),
        "stratified_split": lambda s, d: sampling.stratified_split(_narrow(s, d)).select("id", "class", "split"),
        "stratified_kfold": lambda s, d: sampling.stratified_kfold(_narrow(s, d)).select("id", "class", "fold"),
        "smote_knn": lambda s, d: _rounded(
            sampling.smote_knn(sampling.stratified_split(_stored_features(s, d)).where("split = 'train'")), "distance"
        ),
        "smote_resample": lambda s, d: _rounded(
            _splits(s, d).where("is_synthetic").select("id", "copy_no", "class", *FEATURES), *smote_columns
        ),
        "class_balance_report": on(_splits, sampling.class_balance_report),
        "split_sizes": on(_splits, sampling.split_sizes),
        "assemble": assemble,
        "chain_run": chain_run,
        "clean_pipeline": clean_run,
        "feature_pipeline": lambda s, d: _feature_columns(_featured(s, d)),
        "roc_auc_ranged": on(_scored, evaluate.roc_auc, limit=10),
        "average_precision_ranged": on(_scored, evaluate.average_precision, limit=10),
        "roc_curve_ranged": on(_scored, evaluate.roc_curve, limit=10),
        "pr_curve_ranged": on(_scored, evaluate.pr_curve, limit=10),
        "quantile_threshold_ranged": lambda s, d: _rounded(
            features.quantile_threshold(_narrow(s, d), limit=100), "threshold", digits=9
        ),
        "q09_fraud_streaks_ranged": on(_narrow, reports.q09_fraud_streaks, partitions=64),
        "smote_knn_ranged": lambda s, d: _rounded(
            sampling.smote_knn(
                sampling.stratified_split(_stored_features(s, d)).where("split = 'train'"), cell_rows=64
            ),
            "distance",
        ),
        "smote_knn_hashed": smote_knn_hashed,
        "roc_curve_bounded": lambda s, d: evaluate.roc_curve(_scored(s, d), max_points=40).agg(
            (F.count(F.lit(1)) <= 41).alias("few_points"), F.max("tpr").alias("last_tpr"), F.max("fpr").alias("last_fpr")
        ),
        "confusion_square": confusion_square,
        "report_summary_formatted": report_summary_formatted,
        "report_summary_scaled": report_summary_scaled,
        "removed_rows": removed_rows,
        "dedup_lowest_id": dedup_lowest_id,
        "split_by_threshold": split_by_threshold,
        "feature_run_train_fit": feature_run_train_fit,
        "train_logreg": _trained(models.train_logreg, models.LOGREG),
        "train_tree": _trained(models.train_tree, models.TREE),
        "train_forest": _trained(models.train_forest, models.FOREST),
        "train_gbt": _trained(models.train_gbt, models.BOOSTED),
        "score": score,
        "train_all": train_all,
        "grid_search_forest": grid_search_forest,
        "feature_importance": feature_importance,
        "ml_run": ml_run,
        "ml_pipeline": ml_run,
        "confusion_matrix": on(_scored, evaluate.confusion_matrix),
        "binary_metrics": on(_scored, evaluate.binary_metrics),
        "roc_auc": on(_scored, evaluate.roc_auc),
        "roc_curve": on(_scored, evaluate.roc_curve),
        "pr_curve": on(_scored, evaluate.pr_curve),
        "average_precision": on(_scored, evaluate.average_precision),
        "no_skill_baseline": on(_scored, evaluate.no_skill_baseline),
        "classification_report": on(_scored, evaluate.classification_report),
        "model_comparison": on(_scored_models, evaluate.model_comparison, base="Base"),
        "best_model": on(_scored_models, evaluate.best_model),
        "evaluation_run": evaluation_run,
        "report_summary": lambda s, d: dashboard.report_summary(_narrow(s, d), _scored(s, d)),
        "report_hourly": on(_featured_narrow, dashboard.report_hourly),
        "report_flagged": on(_featured_narrow, dashboard.report_flagged),
        "report_model_table": on(_scored_models, dashboard.report_model_table),
        "report_build": report_build,
    }
