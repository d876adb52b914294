"""Feature creation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import LATE_NIGHT_END, LATE_NIGHT_START, is_late_night
from ..plans.quantiles import quantile, quantile_table
from .clean import fit_scaler, standard_scale

PAIRS = [("v1", "v3"), ("v4", "v11")]


def feat_hour_of_day(df: DataFrame, time_col: str = "time_seconds", out: str = "hour_of_day") -> DataFrame:
    """Hour 0-23 of a seconds offset; negative offsets wrap backwards."""
    hours = F.floor(F.col(time_col) / 3600)
    return df.withColumn(out, F.pmod(hours, F.lit(24).cast("bigint")).cast("int"))


def with_hour(df: DataFrame) -> DataFrame:
    return df if "hour_of_day" in df.columns else feat_hour_of_day(df)


def feat_high_risk_hour(
    df: DataFrame, start: int = LATE_NIGHT_START, end: int = LATE_NIGHT_END, out: str = "high_risk_hour"
) -> DataFrame:
    risky = is_late_night(F.col("hour_of_day"), start, end)
    return with_hour(df).withColumn(out, F.when(risky, 1).otherwise(0))


def feat_amount_zscore(df: DataFrame, out: str = "amount_zscore") -> DataFrame:
    """The scaled amount under its own name."""
    table = df if "amount_scaled" in df.columns else standard_scale(df)
    return table.withColumn(out, F.col("amount_scaled"))


def quantile_threshold(df: DataFrame, col: str = "amount", q: float = 0.99, approx: bool = False, **options) -> DataFrame:
    """One row: the q-quantile (linear interpolation), as it is compared with."""
    return quantile_table(df, col, [q], approx=approx, **options).select(F.col("quantiles")[0].alias("threshold"))


def fit_threshold(df: DataFrame, col: str = "amount", q: float = 0.99, approx: bool = False) -> float | None:
    return quantile(df, col, q, approx=approx)


def feat_high_value_flag(
    df: DataFrame,
    col: str = "amount",
    q: float = 0.99,
    threshold: float | None = None,
    out: str = "high_value_flag",
) -> DataFrame:
    """1 where the value is strictly above the threshold (default: the q-quantile of ``df``)."""
    if threshold is None:
        limit = quantile_threshold(df, col, q).scalar()
    else:
        limit = F.lit(float(threshold))
    return df.withColumn(out, F.when(F.col(col) > limit, 1).otherwise(0))


def feat_interactions(df: DataFrame, pairs: list[tuple[str, str]] = PAIRS) -> DataFrame:
    """Products of column pairs; a pair with a missing column is skipped."""
    present = set(df.columns)
    products = {
        f"{a}_{b}_interact": F.col(a) * F.col(b) for a, b in pairs if a in present and b in present
    }
    return df.withColumns(products) if products else df


def feat_log_amount(df: DataFrame, col: str = "amount", out: str = "log_amount") -> DataFrame:
    return df.withColumn(out, F.log1p(col))


def feat_clip(df: DataFrame, col: str = "amount_zscore", lo: float = -3.0, hi: float = 10.0) -> DataFrame:
    """Clamp to [lo, hi]; null stays null."""
    clipped = F.greatest(F.least(F.col(col), F.lit(hi)), F.lit(lo))
    return df.withColumn(col, F.when(F.col(col).isNotNull(), clipped))


@dataclass(frozen=True)
class FeatureStats:
    """Numbers fitted once and reused by every later scan of the table."""

    mean: float
    sd: float
    high_value: float


def fit_feature_stats(df: DataFrame, amount: str = "amount", q: float = 0.99, approx: bool = False) -> FeatureStats:
    mean, sd = fit_scaler(df, amount) if amount != "amount_scaled" else (0.0, 1.0)
    return FeatureStats(mean, sd, fit_threshold(df, amount, q, approx))


def feature_pipeline(
    df: DataFrame, stats: FeatureStats | None = None, keep: tuple[str, ...] = (), fit_on: DataFrame | None = None
) -> DataFrame:
    """Scaled amount, time, amount and interaction features; drops the raw time and amount.

    A cleaned table has only the scaled amount, which is then used as it is. The high-value flag compares raw amounts
    where there are any. The numbers are fitted on ``fit_on`` (default: ``df``), for instance on the train rows alone.
    """
    amount = "amount" if "amount" in df.columns else "amount_scaled"
    stats = stats or fit_feature_stats(df if fit_on is None else fit_on, amount)
    scaled = standard_scale(df, stats=(stats.mean, stats.sd)) if amount == "amount" else df
    timed = feat_high_risk_hour(feat_hour_of_day(scaled))
    valued = feat_high_value_flag(feat_amount_zscore(timed), amount, threshold=stats.high_value)
    table = feat_interactions(valued)
    return table.drop(*[c for c in ("time_seconds", "amount") if c not in keep])


def feature_count(df: DataFrame, label: str = "class", id_col: str = "id") -> int:
    return len([c for c in df.columns if c not in (label, id_col)])
