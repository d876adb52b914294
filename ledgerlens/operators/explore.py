"""Exploratory aggregates: the data behind the charts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up, percent
from ..plans.quantiles import group_lookup, group_map, quantile_table
from ..sources.schema import DERIVED_FEATURES
from .features import feat_clip, feat_log_amount, with_hour

CORRELATION_COLUMNS = [*[f"v{i}" for i in range(1, 15)], "amount", "class"]


def eda_amount_stats_by_class(df: DataFrame, approx: bool = False) -> DataFrame:
    medians = quantile_table(df, "amount", [0.5], by="class", approx=approx)
    median = group_lookup(medians, "class", F.col("quantiles"))
    grouped = df.groupBy("class").agg(F.avg("amount").alias("mean_v"), F.max("amount").alias("max_v"))
    return grouped.select(
        "class",
        half_up(F.col("mean_v"), 6).alias("mean_amount"),
        half_up(median[0], 6).alias("median_amount"),
        half_up(F.col("max_v"), 6).alias("max_amount"),
    )


def histogram(
    df: DataFrame, col: str, bins: int = 80, by: str = "class", clip: tuple[float, float] | None = None
) -> DataFrame:
    """Equal-width bins per group over the group's own range; empty bins are kept.

    The last bin is closed; a group with a single value gets a range of width 1 around it.
    """
    table = df.select(by, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if clip:
        table = feat_clip(table, "_x", *clip)
    half = F.when(F.max("_x") == F.min("_x"), 0.5).otherwise(0.0)
    bounds = table.groupBy(by).agg((F.min("_x") - half).alias("lo"), (F.max("_x") + half).alias("hi"))
    edges = group_map(bounds, by, F.struct("lo", "hi"))
    edge = F.try_element_at(edges, F.col(by))
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    slot = F.least(F.floor((F.col("_x") - lo) * bins / (hi - lo)), F.lit(bins - 1).cast("bigint"))
    counted = (
        table.withColumn("_e", edge)
        .groupBy(by, slot.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    groups = df.sparkSession.range(1).select(F.explode(F.map_keys(edges)).alias(by))
    empty = groups.select(by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.lit(0).alias("n"))
    full = counted.unionByName(empty).groupBy(by, "bin").agg(F.sum("n").alias("n"))
    width = (hi - lo) / bins
    return full.withColumn("_e", edge).select(
        by,
        "bin",
        half_up(lo + F.col("bin") * width, 6).alias("bin_start"),
        half_up(lo + (F.col("bin") + 1) * width, 6).alias("bin_end"),
        F.col("n"),
    )


def eda_amount_histogram(df: DataFrame, bins: int = 80) -> DataFrame:
    return histogram(df, "amount", bins)


def eda_hourly_volume(df: DataFrame) -> DataFrame:
    hours = with_hour(df).groupBy("hour_of_day").agg(
        F.count("class").alias("total"), F.sum("class").cast("bigint").alias("fraud")
    )
    rate = percent(F.col("fraud"), F.col("total"), 6)
    return hours.withColumn("fraud_rate", rate).orderBy("hour_of_day")


def _hourly_rates(df: DataFrame) -> DataFrame:
    return with_hour(df).groupBy("hour_of_day").agg(F.avg("class").alias("rate"))


def eda_mean_hourly_rate(df: DataFrame) -> DataFrame:
    """Unweighted mean of the hourly rates, in percent."""
    return _hourly_rates(df).agg(half_up(F.avg("rate") * 100, 6).alias("mean_fraud_rate"))


def eda_peak_hour(df: DataFrame) -> DataFrame:
    """Hour with the highest rate; the lowest hour wins a tie."""
    peak = _hourly_rates(df).orderBy(F.desc("rate"), "hour_of_day").limit(1)
    return peak.select(
        F.col("hour_of_day").alias("peak_hour"), half_up(F.col("rate") * 100, 6).alias("fraud_rate")
    )


#: Correlations that one aggregate without groups adds up; more go by first column.
DIRECT_PAIRS = 64


def correlations(df: DataFrame, pairs: list[tuple[str, str]], digits: int = 6) -> DataFrame:
    """Pearson r of column pairs over the rows where both are present; zero variance gives null.

    One scan of mergeable co-moments (count, means, centred products). A matrix is added up row by row: each table row
    meets the array of its own columns once per first column, so there are as many groups as columns. Null and NaN are
    absent values.
    """
    cols = sorted({c for pair in pairs for c in pair})
    absent = F.lit(None).cast("double")
    x = df.select([F.nanvl(F.col(c).cast("double"), absent).alias(c) for c in cols])

    def r(a: Column, b: Column) -> Column:
        spread_a, spread_b = F.regr_sxx(b, a), F.regr_syy(b, a)
        return F.when((spread_a > 0) & (spread_b > 0), F.regr_sxy(b, a) / (F.sqrt(spread_a) * F.sqrt(spread_b)))

    if len(pairs) <= DIRECT_PAIRS:
        found = x.agg(F.array(*[r(F.col(a), F.col(b)) for a, b in pairs]).alias("r")).select(F.posexplode("r").alias("at", "r"))
        listed = [(i, a, b) for i, (a, b) in enumerate(pairs)]
        wanted = ", ".join(f"struct({i} AS at, '{a}' AS column_a, '{b}' AS column_b)" for i, a, b in listed)
        told = df.sparkSession.range(1).select(F.expr(f"inline(array({wanted}))"))
        rows = told.join(F.broadcast(found), "at")
    else:
        each = x.select(F.array(*cols).alias("x")).select("x", F.posexplode("x").alias("i", "a"))
        by = each.groupBy("i").agg(*[r(F.col("a"), F.col("x")[j]).alias(f"r{j}") for j in range(len(cols))])
        matrix = by.select("i", F.array(*[f"r{j}" for j in range(len(cols))]).alias("r"))
        wanted = ", ".join(
            f"struct({cols.index(a)} AS i, {cols.index(b)} AS j, '{a}' AS column_a, '{b}' AS column_b)" for a, b in pairs
        )
        told = df.sparkSession.range(1).select(F.expr(f"inline(array({wanted}))"))
        rows = told.join(F.broadcast(matrix), "i").withColumn("r", F.col("r")[F.col("j")])
    return rows.select("column_a", "column_b", half_up(F.col("r"), digits).alias("r"))


def eda_correlation_matrix(df: DataFrame, cols: list[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Lower triangle without the diagonal: ``column_a`` comes after ``column_b``."""
    return correlations(df, [(b, a) for a, b in combinations(cols, 2)])


def top_correlated(df: DataFrame, cols: list[str], label: str = "class", n: int | None = None) -> DataFrame:
    """|r| of each column with the label, largest first."""
    ranked = (
        correlations(df, [(c, label) for c in cols])
        .select(F.col("column_a").alias("feature"), F.abs("r").alias("abs_corr"))
        .orderBy(F.desc_nulls_last("abs_corr"), "feature")
    )
    return ranked if n is None else ranked.limit(n)


def eda_top_correlated(df: DataFrame, n: int = 10) -> DataFrame:
    return top_correlated(df, [c for c in CORRELATION_COLUMNS if c != "class"], n=n)


def box_stats(df: DataFrame, col: str, by: str = "class", approx: bool = False, digits: int = 6) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR of the box) and the number of points outside."""
    table = df.select(by, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    quartiles = quantile_table(table, "_x", [0.25, 0.5, 0.75], by=by, approx=approx)
    lookup = group_lookup(quartiles, by, F.col("quantiles"))
    q1, q2, q3 = (F.col("_q")[i] for i in range(3))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = F.col("_x").between(low, high)
    grouped = (
        table.withColumn("_q", lookup)
        .groupBy(by)
        .agg(
            F.first("_q").alias("_q"),
            F.min(F.when(inside, F.col("_x"))).alias("_lo"),
            F.max(F.when(inside, F.col("_x"))).alias("_hi"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    # A whisker never ends inside the box.
    return grouped.select(
        by,
        half_up(q1, digits).alias("q1"),
        half_up(q2, digits).alias("median"),
        half_up(q3, digits).alias("q3"),
        half_up(F.least(F.col("_lo"), q1), digits).alias("whisker_low"),
        half_up(F.greatest(F.col("_hi"), q3), digits).alias("whisker_high"),
        "outliers",
    )


def eda_box_stats(df: DataFrame) -> DataFrame:
    return box_stats(df, "amount")


def eda_box_stats_log(df: DataFrame) -> DataFrame:
    return box_stats(feat_log_amount(df), "log_amount")


def fe_fraud_by_hour(df: DataFrame) -> DataFrame:
    return (
        with_hour(df)
        .where("class = 1")
        .groupBy("hour_of_day")
        .agg(F.count(F.lit(1)).alias("fraud_count"))
        .orderBy("hour_of_day")
    )


def fe_fraud_by_risk_flag(df: DataFrame) -> DataFrame:
    """Fraud rows per ``high_risk_hour`` value, both values always present."""
    one_row = df.where("class = 1").agg(
        F.count_if(F.col("high_risk_hour") == 0).alias("n0"),
        F.count_if(F.col("high_risk_hour") == 1).alias("n1"),
    )
    pairs = F.array(
        *[F.struct(F.lit(v).alias("high_risk_hour"), F.col(f"n{v}").alias("fraud_count")) for v in (0, 1)]
    )
    total = F.col("n0") + F.col("n1")
    return one_row.select(total.alias("total"), F.inline(pairs)).select(
        "high_risk_hour",
        "fraud_count",
        percent(F.col("fraud_count"), F.col("total"), 1).alias("share_pct"),
        F.concat_ws(" / ", F.col("fraud_count").cast("string"), F.col("total").cast("string")).alias("of_total"),
    )


def fe_zscore_histogram(df: DataFrame, bins: int = 60, clip: tuple[float, float] = (-3.0, 10.0)) -> DataFrame:
    return histogram(df, "amount_zscore", bins, clip=clip)


def fe_high_value_crosstab(df: DataFrame) -> DataFrame:
    counted = df.groupBy("high_value_flag").pivot("class", [0, 1]).count().na.fill(0)
    return counted.select(
        "high_value_flag", F.col("0").alias("legitimate"), F.col("1").alias("fraud")
    ).orderBy("high_value_flag")


def fe_interaction_corr(df: DataFrame, cols: tuple[str, ...] = ("v1_v3_interact", "v4_v11_interact")) -> DataFrame:
    return correlations(df, [(c, "class") for c in cols]).select(F.col("column_a").alias("feature"), "r")


def fe_feature_corr_ranking(df: DataFrame, cols: list[str] = DERIVED_FEATURES) -> DataFrame:
    return top_correlated(df, cols)
