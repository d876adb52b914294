"""Profiling and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, is_missing
from ..plans.quantiles import quantile_table
from .clean import split_by_repetition

QUARTILES = [0.25, 0.5, 0.75]


def profile_shape(df: DataFrame) -> DataFrame:
    """Row count, column count and the number of columns of each type."""
    types = [t for _, t in df.dtypes]
    census = [F.lit(types.count(t)).cast("bigint").alias(f"{t}_columns") for t in sorted(set(types))]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(types)).cast("bigint").alias("n_columns"), *census
    )


def profile_nulls(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing values per column (null or NaN) and their total, in one pass."""
    types = dict(df.dtypes)
    counted = df.agg(*[F.count_if(is_missing(types, c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns])
    # One row per column of the table.
    long = counted.select(F.inline(pairs)).withColumn(
        "total_nulls", F.sum("null_count").over(Window.partitionBy())
    )
    return long.where("null_count > 0") if only_missing else long


def profile_duplicates(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier identical row."""
    _, repeated = split_by_repetition(df)
    groups = repeated.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def profile_describe(df: DataFrame, col: str = "amount", approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles, max of one column."""
    value = F.col(col)
    quartiles = quantile_table(df, col, QUARTILES, approx=approx).select("quantiles").scalar()
    stats = df.agg(
        F.count(value).alias("count"),
        half_up(F.avg(value), 6).alias("mean"),
        half_up(F.stddev_samp(value), 6).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    names = [F.try_element_at(quartiles, F.lit(i)) for i in (1, 2, 3)]
    return stats.select(
        "count", "mean", "std", "min", *[half_up(c, 6).alias(n) for c, n in zip(names, ("p25", "p50", "p75"))], "max"
    )


def fraud_rate(df: DataFrame, label: str = "class") -> DataFrame:
    """Share of positive rows in percent, and their number."""
    return df.agg(
        half_up(F.avg(label) * 100, 6).alias("fraud_rate_pct"), F.sum(label).cast("bigint").alias("fraud_count")
    )


def class_counts(df: DataFrame, label: str = "class") -> DataFrame:
    """Rows per class, largest first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label)


def head_preview(df: DataFrame, n: int = 5, order: str | Column = "id") -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(order).limit(n)
