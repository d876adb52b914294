"""Report tables for the audit dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import DASHBOARD_BANDS, audit_label, risk_band, risk_level_by_flags
from ..functions.numeric import half_up, percent, ratio
from ..plans.ordering import with_global_index
from .evaluate import binary_metrics, flag_best, model_metrics, roc_auc


def _mean(amount: Column, label: int) -> Column:
    return F.avg(F.when(F.col("class") == label, amount))


def report_summary(df: DataFrame, scored: DataFrame, amount_col: str = "amount", digits: int = 6) -> DataFrame:
    """Nine KPIs in one row; amounts are 0 when the column is absent."""
    amount = F.col(amount_col) if amount_col in df.columns else F.lit(0.0)
    metrics = binary_metrics(scored, digits).select(F.struct("recall", "f1")).scalar()
    table = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("class").cast("bigint").alias("fraud"),
        half_up(_mean(amount, 0), digits).alias("avg_legit_amt"),
        half_up(_mean(amount, 1), digits).alias("avg_fraud_amt"),
        half_up(F.max(F.when(F.col("class") == 1, amount)), digits).alias("max_fraud_amt"),
    )
    return table.withColumns(
        {
            "fraud_rate": percent(F.col("fraud"), F.col("total"), digits),
            "roc_auc": roc_auc(scored, digits).scalar(),
            "recall": metrics["recall"],
            "f1": metrics["f1"],
        }
    ).select(
        "total", "fraud", "fraud_rate", "roc_auc", "recall", "f1", "avg_legit_amt", "avg_fraud_amt", "max_fraud_amt"
    )


def report_summary_formatted(summary: DataFrame) -> DataFrame:
    """The KPIs as ``metric, value`` text."""
    def dollars(name: str) -> Column:
        return F.concat(F.lit("$"), F.format_string("%.2f", F.col(name)))

    # The names of the nine numbers.
    cells = [
        ("Total Transactions", F.format_number("total", 0)),
        ("Fraudulent", F.format_number("fraud", 0)),
        ("Fraud Rate", F.format_string("%.4f%%", F.col("fraud_rate"))),
        ("Model ROC-AUC", F.format_string("%.4f", F.col("roc_auc"))),
        ("Recall (Fraud)", F.format_string("%.4f", F.col("recall"))),
        ("F1-Score (Fraud)", F.format_string("%.4f", F.col("f1"))),
        ("Avg. Legit Amount", dollars("avg_legit_amt")),
        ("Avg. Fraud Amount", dollars("avg_fraud_amt")),
        ("Max Fraud Amount", dollars("max_fraud_amt")),
    ]
    rows = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in cells]
    return summary.select(F.inline(F.array(*rows)))


def report_hourly(df: DataFrame, digits: int = 9) -> DataFrame:
    """Per hour: rows, frauds, rate as a fraction, risk band. Without an hour column all is hour 0."""
    table = df if "hour_of_day" in df.columns else df.withColumn("hour_of_day", F.lit(0))
    hours = table.groupBy(F.col("hour_of_day").alias("hour")).agg(
        F.count("class").alias("total"), F.sum("class").cast("bigint").alias("fraud_count")
    )
    return hours.select(
        "hour",
        "total",
        "fraud_count",
        half_up(ratio(F.col("fraud_count"), F.col("total")), digits).alias("fraud_rate"),
        risk_band(F.col("hour"), DASHBOARD_BANDS).alias("risk_band"),
    ).orderBy("hour")


def report_flagged(df: DataFrame, limit: int | None = None, amount_col: str = "amount") -> DataFrame:
    """The fraud rows by falling amount: number, amount, hour, z-score, risk level, audit label.

    All of them, in no order but by their number, or the first ``limit`` to show on one sheet, in order.
    """
    def optional(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(0)

    wanted = [c for c in ("id", "class", amount_col, "hour_of_day", "amount_scaled", "high_value_flag", "high_risk_hour")]
    first = df.where("class = 1").select([c for c in dict.fromkeys(wanted) if c in df.columns])
    if limit is not None:
        first = first.orderBy(F.desc(amount_col), "id").limit(limit)
    falling = first.withColumns({"_missing": F.col(amount_col).isNull(), "_falling": -F.col(amount_col)})
    numbered = with_global_index(falling, ["_missing", "_falling", "id"], "_place")
    if limit is not None:
        numbered = numbered.orderBy("_place")
    return numbered.select(
        (F.col("_place") + 1).alias("txn_no"),
        "id",
        half_up(F.col(amount_col), 2).alias("amount"),
        optional("hour_of_day").alias("hour_of_day"),
        half_up(optional("amount_scaled"), 4).alias("amount_scaled"),
        risk_level_by_flags(optional("high_value_flag"), optional("high_risk_hour")).alias("risk_level"),
        audit_label(F.col("class")).alias("confirmed_fraud"),
    )


def report_model_table(scored: DataFrame, digits: int = 4) -> DataFrame:
    """Metrics of every model, rounded, with the best ROC area flagged."""
    flagged = flag_best(model_metrics(scored))
    rounded = [half_up(F.col(c), digits).alias(c) for c in ("roc_auc", "recall", "precision", "f1")]
    return flagged.orderBy("position").select("name", *rounded, "is_best")
