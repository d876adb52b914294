"""Exact linear-interpolated quantiles with bounded memory per task.

``percentile`` keeps every distinct value of a group in one aggregation buffer. That is used only
while a group has at most ``limit`` rows. Larger groups are narrowed by equal-width histograms
(one scan, a bounded number of map-side combined counters per scan) until the interval around each
wanted rank holds few rows or a single value, so nothing is sorted, collected or approximated.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_LIMIT = 1_000_000
BINS = 4096


@dataclass(frozen=True)
class _Interval:
    """Rows of ``group`` with lo <= value <= hi; ``before`` rows of the group are smaller."""

    group: object
    lo: float
    hi: float
    before: int
    rows: int


def _clean(df: DataFrame, col: str, by: str | None) -> DataFrame:
    value = F.col(col).cast("double")
    group = F.col(by) if by else F.lit(0)
    return df.select(group.alias("g"), value.alias("x")).where(
        F.col("x").isNotNull() & ~F.isnan("x") & F.col("g").isNotNull()
    )


def _inside(interval: _Interval) -> Column:
    return (F.col("g") == F.lit(interval.group)) & F.col("x").between(interval.lo, interval.hi)


def _refine(values: DataFrame, intervals: list[_Interval], wanted: dict[_Interval, list[int]], bins: int):
    """One scan: split each interval into ``bins`` and keep the bin that holds each wanted rank."""
    code = bin_no = None
    for i, iv in enumerate(intervals):
        step = (iv.hi / bins) - (iv.lo / bins)
        last = F.lit(bins - 1).cast("bigint")
        if step > 0:
            slot = F.least(F.floor((F.col("x") - iv.lo) / F.lit(step)), last)
        else:  # lo and hi are neighbouring doubles
            slot = F.when(F.col("x") <= iv.lo, F.lit(0).cast("bigint")).otherwise(last)
        code = F.when(_inside(iv), i) if code is None else code.when(_inside(iv), i)
        bin_no = F.when(_inside(iv), slot) if bin_no is None else bin_no.when(_inside(iv), slot)
    counted = (
        values.select(code.alias("i"), bin_no.alias("b"), "x")
        .where(F.col("i").isNotNull())
        .groupBy("i", "b")
        .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .collect()  # at most len(intervals) * bins rows
    )
    found: dict[_Interval, list[int]] = {}
    for i, iv in enumerate(intervals):
        before = iv.before
        for row in sorted((r for r in counted if r.i == i), key=lambda r: r.b):
            ranks = [k for k in wanted[iv] if before <= k < before + row.n]
            if ranks:
                found[_Interval(iv.group, row.lo, row.hi, before, row.n)] = ranks
            before += row.n
    return found


def _finish(values: DataFrame, interval: _Interval, ranks: list[int]) -> dict[int, float]:
    """Order statistics inside an interval of at most ``limit`` rows."""
    counts = values.where(_inside(interval)).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    running = counts.withColumn("upto", upto + interval.before)
    picks = [F.min(F.when(F.col("upto") > k, F.col("x"))).alias(f"r{k}") for k in ranks]
    row = running.agg(*picks).first()
    return {k: row[f"r{k}"] for k in ranks}


def _order_statistics(values: DataFrame, ranges: list, ranks: dict, limit: int, bins: int) -> dict:
    """``{(group, rank): value}`` for 0-based ranks; infinities stand before and behind the finite values."""
    out: dict = {}
    pending: dict[_Interval, list[int]] = {}
    for r in ranges:
        finite = r.n - r.below - r.above
        inside = []
        for k in sorted(ranks.get(r.g, ())):
            if k < r.below:
                out[(r.g, k)] = -math.inf
            elif k >= r.below + finite:
                out[(r.g, k)] = math.inf
            else:
                inside.append(k)
        if inside:
            pending[_Interval(r.g, r.lo, r.hi, r.below, finite)] = inside
    while pending:
        wide: dict[_Interval, list[int]] = {}
        for iv, ks in pending.items():
            if iv.lo == iv.hi:
                out.update({(iv.group, k): iv.lo for k in ks})
            elif iv.rows <= limit:
                out.update({(iv.group, k): v for k, v in _finish(values, iv, ks).items()})
            else:
                wide[iv] = ks
        pending = _refine(values, list(wide), wide, bins) if wide else {}
    return out


def quantile_table(
    df: DataFrame,
    col: str,
    qs: list[float],
    by: str | None = None,
    approx: bool = False,
    limit: int = ROW_LIMIT,
    bins: int = BINS,
) -> DataFrame:
    """One row per group: ``[by,] quantiles array<double>`` in the order of ``qs``.

    ``approx=True`` uses the mergeable sketch instead.
    """
    spark = df.sparkSession
    values = _clean(df, col, by)
    names = [F.col("g").alias(by)] if by else []
    probs = F.array(*[F.lit(float(q)) for q in qs])
    if approx:
        sketch = F.percentile_approx("x", [float(q) for q in qs], 10000)
        return values.groupBy("g").agg(sketch.alias("quantiles")).select(*names, "quantiles")
    finite = F.when(F.abs("x") < math.inf, F.col("x"))
    ranges = values.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(finite).alias("lo"),
        F.max(finite).alias("hi"),
        F.count_if(F.col("x") == -math.inf).alias("below"),
        F.count_if(F.col("x") == math.inf).alias("above"),
    ).collect()  # one row per group
    if all(r.n <= limit for r in ranges):
        exact = values.groupBy("g").agg(F.percentile("x", probs).alias("quantiles"))
        return exact.select(*names, "quantiles")
    ranks: dict = {}
    for r in ranges:
        wanted: set[int] = set()
        for q in qs:
            pos = (r.n - 1) * q
            wanted |= {math.floor(pos), math.ceil(pos)}
        ranks[r.g] = wanted
    stats = _order_statistics(values, ranges, ranks, limit, bins)
    rows = []
    for r in ranges:
        result = []
        for q in qs:
            pos = (r.n - 1) * q
            low, high = math.floor(pos), math.ceil(pos)
            a, b = stats[(r.g, low)], stats[(r.g, high)]
            # Same interpolation rule as the built-in percentile.
            result.append(a if a == b else (high - pos) * a + (pos - low) * b)
        rows.append((r.g, result))
    kind = values.schema["g"].dataType.simpleString()
    return spark.createDataFrame(rows, f"g {kind}, quantiles array<double>").select(*names, "quantiles")


def quantile(df: DataFrame, col: str, q: float, approx: bool = False, **options) -> float | None:
    """One quantile of the whole column as a number; None when there is no value."""
    row = quantile_table(df, col, [q], approx=approx, **options).first()
    return None if row is None else row["quantiles"][0]


def group_map(table: DataFrame, by: str, value: Column) -> Column:
    """``table`` (one row per group of a label column) as a one-row subquery: a map by group."""
    return table.agg(F.map_from_entries(F.collect_list(F.struct(F.col(by), value)))).scalar()


def group_lookup(table: DataFrame, by: str, value: Column) -> Column:
    """The value of each row's group, without a join."""
    return F.try_element_at(group_map(table, by, value), F.col(by))
