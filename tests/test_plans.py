"""The distributed patterns against plain single-window answers."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import hash32
from ledgerlens.plans import ordering
from ledgerlens.plans.ordering import rank_cuts, rolling_sum, running_totals, with_global_index
from ledgerlens.plans.quantiles import quantile, quantile_table


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows; a third of them share one value and one time."""
    table = spark.range(5000).withColumn("u", hash32("t", F.col("id")) / 2.0**32)
    return table.select(
        "id",
        F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.round(F.exp(F.col("u") * 12) - 50, 2)).alias("x"),
        F.when(F.col("id") % 3 == 1, 100.0).otherwise(F.floor(F.col("u") * 400).cast("double")).alias("time"),
        (hash32("c", F.col("id")) % 5 == 0).cast("int").alias("class"),
    ).cache()


@pytest.mark.parametrize("limit,bins", [(10**6, 4096), (100, 16), (1, 7), (0, 2)])
def test_quantiles_are_exact(skewed, limit, bins):
    qs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    rows = quantile_table(skewed, "x", qs, by="class", limit=limit, bins=bins).collect()
    for row in rows:
        values = [r.x for r in skewed.where(F.col("class") == row["class"]).select("x").collect()]
        assert row["quantiles"] == pytest.approx(list(np.quantile(values, qs)), rel=1e-12, abs=1e-12)
    assert len(rows) == 2


def test_quantile_edges(spark, skewed):
    assert quantile(skewed.where("id < 0"), "x", 0.5) is None
    assert quantile(skewed.where("id = 4"), "x", 0.3, limit=0) == skewed.where("id = 4").first().x
    same = spark.range(50).select(F.lit(3.25).alias("x"))
    assert quantile(same, "x", 0.99, limit=5) == 3.25
    gaps = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert quantile(gaps, "x", 0.5) == 2.0
    close = spark.createDataFrame([(1.0,), (float(np.nextafter(1.0, 2)),)] * 20, "x double")
    assert quantile(close, "x", 1.0, limit=5) == float(np.nextafter(1.0, 2))


def test_global_index_is_dense_and_ordered(skewed):
    rows = with_global_index(skewed, ["time", "id"], partitions=16).orderBy("rn").collect()
    assert [r.rn for r in rows] == list(range(5000))
    keys = [(r.time, r.id) for r in rows]
    assert keys == sorted(keys)


@pytest.mark.parametrize("n,partitions", [(10, 16), (10, 1), (3, 64), (1, 5)])
def test_rolling_sum_equals_one_window(skewed, n, partitions):
    got = rolling_sum(skewed.select("id", "time", "class"), "class", ["time", "id"], n, "s", partitions)
    window = Window.orderBy("time", "id").rowsBetween(-(n - 1), 0)
    want = skewed.withColumn("s", F.sum("class").over(window))
    assert {(r.id, r.s) for r in got.collect()} == {(r.id, r.s) for r in want.collect()}


@pytest.mark.parametrize("rows", [0, 1, 7, 40])
def test_rolling_sum_over_ranges_shorter_than_the_frame(spark, rows):
    """More ranges than rows, and a null that counts as nothing; doubles too."""
    values = [None if i == 3 else float(i * i % 11) for i in range(rows)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    got = {r.id: r.s for r in rolling_sum(df, "v", ["id"], 10, "s", 30).collect()}
    assert got == {i: sum(v or 0 for v in values[max(0, i - 9) : i + 1]) for i in range(rows)}


def test_rolling_sum_shuffles_its_rows_once(skewed):
    import ledgerlens.plans.ordering as ordering

    plans = []
    real = ordering.materialize
    ordering.materialize = lambda df, label: plans.append(df) or real(df, label)
    try:
        rolling_sum(skewed.select("id", "time", "class"), "class", ["time", "id"], 10, "s")
    finally:
        ordering.materialize = real
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert len(plans) == 1 and text.count("Exchange") == 1 and "rangepartitioning" in text


def test_rolling_sum_needs_a_frame(skewed):
    with pytest.raises(ValueError):
        rolling_sum(skewed, "class", ["time", "id"], 0, "s")


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("by", [[], ["class"]])
def test_running_totals_by_ranges(skewed, descending, by):
    counts = skewed.groupBy(*by, "x").agg(F.count("*").alias("n"), F.sum("id").alias("m"))
    small = running_totals(counts, "x", ["n", "m"], by, descending)
    ranged = running_totals(counts, "x", ["n", "m"], by, descending, limit=100)
    cols = [*by, "x", "n", "m", "cum_n", "cum_m"]
    assert sorted(small.select(cols).collect()) == sorted(ranged.select(cols).collect())


@pytest.mark.parametrize("kind", ["shared", "spread", "one prefix", "dense"])
def test_rank_cuts(skewed, kind, monkeypatch):
    coarse = {
        "shared": (F.col("id") % 11 * 65536 + F.col("id") % 3).cast("bigint"),
        "spread": hash32("r", F.col("id")),
        "one prefix": F.lit(2**32 - 1).cast("bigint"),
        "dense": (F.col("id") % 4099 + 7).cast("bigint"),
    }[kind]
    if kind == "dense":
        monkeypatch.setattr(ordering, "_NEXT_BITS", 5)
    wanted = {0: [0, 1, 777, 4000, 10**9], 1: [5]}
    sizes, cuts = rank_cuts(skewed, coarse, "id", "class", lambda _: wanted)
    for group, group_cuts in cuts.items():
        part = skewed.where(F.col("class") == group).withColumn("h", coarse)
        ordered = [r.id for r in part.orderBy("h", "id").collect()]
        assert sizes[group] == len(ordered)
        assert [c.rank for c in group_cuts] == wanted[group]
        for cut in group_cuts:
            picked = part.where(cut.covers(F.col("h"), F.col("id"))).collect()
            assert {r.id for r in picked} == set(ordered[: cut.rank])
