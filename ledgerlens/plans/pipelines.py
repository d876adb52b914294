"""End-to-end pipelines: clean, train, evaluate, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, dashboard, evaluate, features, models, profile
from ..operators.sampling import resampled_splits
from ..session import materialize, scratch_scope
from ..sources import files
from ..sources.schema import CLEANED_SCHEMA, FEATURES
from .ordering import with_global_index


def inspect(df: DataFrame) -> dict[str, DataFrame]:
    """The data-quality tables of a raw table (lazy)."""
    return {
        "shape": profile.profile_shape(df),
        "nulls": profile.profile_nulls(df),
        "fraud_rate": profile.fraud_rate(df),
    }


def clean_table(df: DataFrame, hash_col: str | None = None) -> DataFrame:
    """Drop duplicates, number the rows, scale the amount, drop the raw amount, label last.

    The id is the place of a row in the order of all its columns, so the same rows always get the same ids.
    """
    order = [c for c in df.columns if c != hash_col]
    unique = with_global_index(clean.dedup_rows(df, hash_col=hash_col), order, "id").select("id", *order)
    scaled = clean.standard_scale(unique, stats=clean.fit_scaler(unique))
    return clean.reorder_label_last(clean.drop_columns(scaled, "amount"))


def clean_pipeline(spark: SparkSession, raw_path: str, out_path: str, compression: str | None = None) -> DataFrame:
    """Raw CSV to cleaned CSV (compressed if asked for); returns the cleaned table as read back from ``out_path``.

    The text is parsed once, into a columnar copy with the row hash: finding repeats reads only the
    hash, fitting the scaler the hash and the amount.
    """
    raw = files.raw_to_transactions(files.load_raw(spark, raw_path))
    with scratch_scope(spark):
        staged = materialize(raw.withColumn("_h", clean.row_hash(raw.columns)), "staged")
        files.save(clean_table(staged, hash_col="_h"), out_path, compression=compression)
    return files.load_raw(spark, out_path, CLEANED_SCHEMA)


def features_and_splits(df: DataFrame, features_path: str, splits_path: str, **options) -> DataFrame:
    """Feature table, then split and over-sampled train rows; both are stored and read back.

    Splitting passes over the stored features several times, mostly over a few of their columns.
    """
    spark = df.sparkSession
    featured = features.feature_pipeline(df)
    files.save(featured, features_path, "parquet")
    stored = spark.read.schema(featured.schema).parquet(features_path)
    with scratch_scope(spark):
        files.save_splits(resampled_splits(stored, **options), splits_path)
    return files.load_splits(spark, splits_path)


@dataclass
class TrainingResult:
    scored: DataFrame
    metrics: DataFrame
    grid: DataFrame
    importance: DataFrame
    best: PipelineModel
    recall_gain_pct: float | None


def ml_pipeline(
    spark: SparkSession,
    splits_path: str,
    model_path: str,
    feature_names: list[str] = FEATURES,
    label: str = "class",
    settings: dict[str, dict] | None = None,
    **tuning,
) -> TrainingResult:
    """Baselines, tuned forest, importances, recall gain; saves the tuned model."""
    train = files.load_splits(spark, splits_path, "train")
    test = files.load_splits(spark, splits_path, "test")
    folds = models.search_rows(train, label, tuning.get("folds", 5))
    with models.ready_rows(folds, feature_names, label, "fold") as kept:  # assembled once for baselines and search
        fitted, _ = models.train_all(train, test, feature_names, label, settings, kept)
        search = models.grid_search_forest(train, feature_names, label, kept=kept, **tuning)
    fitted[models.TUNED] = models.best_pipeline(search, feature_names)
    files.save_model(fitted[models.TUNED], model_path)
    scored = materialize(models.score_all(fitted, test, label), "scored")
    metrics = materialize(evaluate.model_comparison(scored, base=models.FOREST), "metrics").orderBy("position")
    gain = metrics.where(metrics["name"] == models.TUNED).first()["recall_gain_pct"]
    return TrainingResult(
        scored,
        metrics,
        models.grid_table(spark, search),
        models.feature_importance(spark, fitted[models.TUNED], feature_names),
        fitted[models.TUNED],
        gain,
    )


def evaluation_run(
    spark: SparkSession, model_path: str, splits_path: str, feature_names: list[str] = FEATURES
) -> dict[str, DataFrame]:
    """Load the model and the test rows; every metric and curve as a table.

    The model is applied once and scores are counted once; the tables are made from what is stored then.
    """
    model = files.load_model(model_path)
    scored = materialize(models.score(model, files.load_splits(spark, splits_path, "test")), "scored")
    table = materialize(evaluate.score_table(scored, range_col="_range"), "score-table")
    return {
        "classification_report": evaluate.classification_report(scored),
        "confusion_matrix": evaluate.confusion_matrix(scored),
        "roc_curve": evaluate.roc_curve(scored, table=table),
        "pr_curve": evaluate.pr_curve(scored, table=table),
        "roc_auc": evaluate.roc_auc(scored, table=table),
        "average_precision": evaluate.average_precision(scored, table=table),
        "no_skill_baseline": evaluate.no_skill_baseline(scored),
        "feature_importance": models.feature_importance(spark, model, feature_names),
    }


def report_build(
    df: DataFrame, best_scored: DataFrame, all_scored: DataFrame, root: str, amount_col: str = "amount"
) -> dict[str, DataFrame]:
    """All four report sections, written under ``root`` and read back.

    The featured table is read by three of them and kept meanwhile. ``amount_col`` may be ``amount_scaled``, the only
    amount that a cleaned table has.
    """
    spark = df.sparkSession
    featured = features.feature_pipeline(df, keep=("amount",))
    wanted = [
        c
        for c in ("id", "class", "amount", "amount_scaled", "hour_of_day", "high_risk_hour", "high_value_flag")
        if c in featured.columns
    ]
    with scratch_scope(spark):
        kept = materialize(featured.select(wanted), "report-rows")
        paths = files.save_report(
            {
                "summary": dashboard.report_summary(kept, best_scored, amount_col),
                "hourly": dashboard.report_hourly(kept),
                "flagged": dashboard.report_flagged(kept, amount_col=amount_col),
                "models": dashboard.report_model_table(all_scored),
            },
            root,
        )
    return files.load_report(spark, paths)
