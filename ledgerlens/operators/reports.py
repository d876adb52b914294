"""The report queries over the transactions table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import QUERY_BANDS, class_label, risk_band, risk_level_by_amount, time_block
from ..functions.numeric import half_up, percent
from ..plans.ordering import rolling_sum
from ..plans.quantiles import group_lookup, quantile_table
from .clean import standard_scale
from .features import with_hour

# Alert thresholds.
THRESHOLDS = (50, 100, 200, 500, 1000, 2000, 5000)


def _with_scaled(df: DataFrame) -> DataFrame:
    return df if "amount_scaled" in df.columns else standard_scale(df)


def _rows() -> Column:
    return F.count(F.lit(1))


def _frauds() -> Column:
    return F.sum("class").cast("bigint")


def _share_of_total(count: str, digits: int) -> Column:
    # Runs over the few rows of a grouped result.
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()), digits)


def q01_class_distribution(df: DataFrame) -> DataFrame:
    grouped = df.groupBy("class").agg(_rows().alias("total_count"))
    labelled = grouped.withColumn("percentage", _share_of_total("total_count", 4))
    return labelled.orderBy(F.desc("class")).select(
        class_label(F.col("class")).alias("transaction_type"), "total_count", "percentage"
    )


def q02_top_fraud(df: DataFrame, n: int = 20) -> DataFrame:
    table = with_hour(_with_scaled(df))
    top = table.where("class = 1").orderBy(F.desc("amount"), "id").limit(n)
    return top.select(
        "id",
        half_up(F.col("amount"), 2).alias("amount_usd"),
        "hour_of_day",
        half_up(F.col("amount_scaled"), 4).alias("amount_z_score"),
    )


def q03_amount_by_class(df: DataFrame, approx: bool = False) -> DataFrame:
    medians = quantile_table(df, "amount", [0.5], by="class", approx=approx)
    median = group_lookup(medians, "class", F.col("quantiles"))
    grouped = df.groupBy("class").agg(
        F.avg("amount").alias("avg_v"),
        F.max("amount").alias("max_v"),
        F.min("amount").alias("min_v"),
        _rows().alias("count"),
    )
    return grouped.select(
        class_label(F.col("class")).alias("transaction_type"),
        half_up(F.col("avg_v"), 2).alias("avg_amount"),
        half_up(median[0], 2).alias("median_amount"),
        half_up(F.col("max_v"), 2).alias("max_amount"),
        half_up(F.col("min_v"), 2).alias("min_amount"),
        "count",
    )


def q04_fraud_by_hour(df: DataFrame, bands: tuple[str, str, str] = QUERY_BANDS) -> DataFrame:
    hours = with_hour(df).where("class = 1").groupBy("hour_of_day").agg(_rows().alias("fraud_count"))
    return hours.select(
        "hour_of_day",
        "fraud_count",
        _share_of_total("fraud_count", 2).alias("pct_of_all_fraud"),
        risk_band(F.col("hour_of_day"), bands).alias("risk_band"),
    ).orderBy(F.desc("fraud_count"), "hour_of_day")


def q05_fraud_rate_by_hour(df: DataFrame) -> DataFrame:
    hours = with_hour(df).groupBy("hour_of_day").agg(
        _rows().alias("total_transactions"), _frauds().alias("fraud_count")
    )
    rate = percent(F.col("fraud_count"), F.col("total_transactions"), 4)
    return hours.withColumn("fraud_rate_pct", rate).orderBy(F.desc("fraud_rate_pct"), "hour_of_day")


def q06_fraud_above_p95(df: DataFrame, q: float = 0.95, approx: bool = False) -> DataFrame:
    table = with_hour(_with_scaled(df)).where("class = 1")
    fraud = df.where("class = 1")
    limit = quantile_table(fraud, "amount", [q], approx=approx).select(F.col("quantiles")[0].alias("limit"))
    return (
        table.where(F.col("amount") > limit.scalar())
        .orderBy(F.desc("amount"), "id")
        .select(
            "id",
            half_up(F.col("amount"), 2).alias("amount_usd"),
            "hour_of_day",
            half_up(F.col("amount_scaled"), 6).alias("amount_scaled"),
        )
    )


def q07_time_blocks(df: DataFrame, width: int = 6) -> DataFrame:
    blocks = with_hour(df).groupBy(time_block(F.col("hour_of_day"), width).alias("time_block")).agg(
        _rows().alias("total_txns"), _frauds().alias("fraud_count"), F.avg("amount").alias("mean_v")
    )
    return blocks.select(
        "time_block",
        "total_txns",
        "fraud_count",
        percent(F.col("fraud_count"), F.col("total_txns"), 4).alias("fraud_rate_pct"),
        half_up(F.col("mean_v"), 2).alias("avg_amount"),
    ).orderBy(F.desc("fraud_rate_pct"), "time_block")


def _coverage_columns(total: Column) -> list[Column]:
    pct = percent(F.col("fraud_above_threshold"), total, 2)
    return [F.col("amount_threshold"), F.col("fraud_above_threshold"), total.alias("total_fraud"), pct.alias("pct_fraud_captured")]


def q08_threshold_coverage(df: DataFrame, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """All thresholds in one pass over the fraud rows."""
    counts = [F.count_if(F.col("amount") >= t).alias(f"n{i}") for i, t in enumerate(thresholds)]
    one_row = df.where("class = 1").agg(_rows().alias("total"), *counts)
    pairs = F.array(
        *[
            F.struct(F.lit(t).alias("amount_threshold"), F.col(f"n{i}").alias("fraud_above_threshold"))
            for i, t in enumerate(thresholds)
        ]
    )
    return (
        one_row.select("total", F.inline(pairs))
        .select(*_coverage_columns(F.col("total")))
        .orderBy("amount_threshold")
    )


def q08_threshold_coverage_join(df: DataFrame, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """The same result from a table of thresholds.

    Fraud rows are first counted per band (the largest threshold they reach), so the inequality join
    only meets one row per threshold on either side.
    """
    levels = F.array(*[F.lit(int(t)) for t in thresholds])
    table = df.sparkSession.range(1).select(F.explode(levels).alias("amount_threshold"))
    reached = [F.when(F.col("amount") >= t, t) for t in thresholds]
    band = F.greatest(*reached) if len(reached) > 1 else reached[0]
    bands = df.where("class = 1").groupBy(band.alias("band")).agg(_rows().alias("n"))
    joined = table.join(F.broadcast(bands), F.col("band") >= F.col("amount_threshold"), "left")
    total = bands.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    return (
        joined.groupBy("amount_threshold")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("fraud_above_threshold"))
        .withColumn("total", total)
        .select(*_coverage_columns(F.col("total")))
        .orderBy("amount_threshold")
    )


def q09_fraud_streaks(df: DataFrame, n: int = 10, min_hits: int = 3, partitions: int | None = None) -> DataFrame:
    rows = df.select("id", "time_seconds", "class")
    summed = rolling_sum(rows, "class", ["time_seconds", "id"], n, "fraud_in_last_10", partitions)
    return summed.where(F.col("fraud_in_last_10") >= min_hits).orderBy("time_seconds", "id")


def q10_audit_flags(
    df: DataFrame, high: float = 500, mid: float = 200, hours: tuple[int, int] = (0, 4)
) -> DataFrame:
    table = with_hour(_with_scaled(df))
    amount, hour = F.col("amount"), F.col("hour_of_day")
    flagged = table.where((F.col("class") == 1) | ((amount > high) & hour.between(*hours)))
    return flagged.orderBy(F.desc("amount"), "hour_of_day", "id").select(
        F.col("id").alias("transaction_id"),
        half_up(amount, 2).alias("amount_usd"),
        "hour_of_day",
        half_up(F.col("amount_scaled"), 6).alias("z_score"),
        risk_level_by_amount(amount, hour, high, mid, hours).alias("risk_level"),
        F.col("class").alias("is_fraud"),
    )


def q11_hour_range_share(df: DataFrame, hours: tuple[int, int] = (2, 4)) -> DataFrame:
    inside = F.col("hour_of_day").between(*hours)
    counted = with_hour(df).where("class = 1").agg(
        F.count_if(inside).alias("fraud_in_range"), _rows().alias("total_fraud")
    )
    pct = percent(F.col("fraud_in_range"), F.col("total_fraud"), 2)
    return counted.withColumn("pct_of_all_fraud", pct)
