import math

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ledgerlens.functions.labels import DASHBOARD_BANDS, risk_band, risk_level_by_amount, risk_level_by_flags, time_block
from ledgerlens.functions.numeric import half_up, percent
from ledgerlens.operators import clean, features, profile
from ledgerlens.sources import files, fixtures


def _column(df, name="x"):
    return [r[name] for r in df.collect()]


def test_half_up_rounds_ties_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (0.125,), (None,)], "v double")
    assert _column(df.select(half_up(F.col("v"), 2).alias("x"))) == [1.01, -1.01, 2.68, 0.13, None]


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a int, b int")
    assert _column(df.select(percent(F.col("a"), F.col("b"), 4).alias("x"))) == [33.3333, None]


def test_hours_and_bands(spark):
    hours = [0, 4, 5, 8, 9, 19, 20, 22, 23]
    df = spark.createDataFrame([(h,) for h in hours], "hour_of_day int")
    h = F.col("hour_of_day")
    high, mid, low = DASHBOARD_BANDS
    assert _column(df.select(risk_band(h, DASHBOARD_BANDS).alias("x"))) == [high, high, mid, mid, low, low, mid, mid, high]
    assert _column(features.feat_high_risk_hour(df), "high_risk_hour") == [1, 1, 0, 0, 0, 0, 0, 0, 1]
    blocks = _column(df.select(time_block(h).alias("x")))
    assert blocks[0] == "00:00–05:59 (Night)" and blocks[4] == "06:00–11:59 (Morning)" and blocks[-1] == "18:00–23:59 (Evening)"
    assert _column(df.select(time_block(h, 12).alias("x")))[-1] == "12:00–23:59"
    with pytest.raises(ValueError):
        time_block(h, 7)


def test_hour_of_negative_and_late_times(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (3599.99,), (86400.0,), (90000.0,), (None,)], "time_seconds double")
    assert _column(features.feat_hour_of_day(df), "hour_of_day") == [23, 0, 0, 0, 1, None]


def test_risk_levels(spark):
    df = spark.createDataFrame(
        [(500.01, 4, 1, 1), (500.0, 4, 1, 0), (200.0, 0, 0, 1), (200.0, 23, 0, 0)], "a double, h int, v int, r int"
    )
    assert _column(df.select(risk_level_by_amount(F.col("a"), F.col("h")).alias("x"))) == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert _column(df.select(risk_level_by_flags(F.col("v"), F.col("r")).alias("x"))) == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def test_scale_constant_column_is_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "amount double")
    assert _column(clean.standard_scale(df), "amount_scaled") == [0.0, 0.0, None]


def test_scale_on_another_table(spark):
    fit = spark.createDataFrame([(0.0,), (10.0,)], "amount double")
    df = spark.createDataFrame([(20.0,)], "amount double")
    assert _column(clean.standard_scale(df, fit_on=fit), "amount_scaled") == [3.0]
    assert _column(clean.standard_scale(df, stats=clean.fit_scaler(fit)), "amount_scaled") == [3.0]


@pytest.fixture(params=[0, 8])
def row_width(request, monkeypatch):
    """With 0 the hash route is taken for narrow rows too."""
    monkeypatch.setattr(clean, "WIDE_ROW", request.param)


def test_dedup_is_null_safe(spark, row_width):
    df = spark.createDataFrame([(1, None), (1, None), (None, 1), (None, None), (2, 3)], "a int, b int")
    assert sorted(map(str, clean.dedup_rows(df).collect())) == sorted(
        map(str, df.distinct().collect())
    )
    row = profile.profile_duplicates(df).first()
    assert row.duplicate_rows == 1


@pytest.mark.parametrize("most_keys", [10**6, 0])
def test_dedup_with_id_keeps_the_smallest(spark, monkeypatch, row_width, most_keys):
    monkeypatch.setattr(clean, "BROADCAST_KEYS", most_keys)
    df = spark.createDataFrame([(5, "a"), (2, "a"), (9, "b"), (1, None), (4, None)], "id bigint, v string")
    kept = clean.dedup_rows(df, "id")
    assert kept.columns == ["id", "v"]
    assert sorted(r.id for r in kept.collect()) == [1, 2, 9]
    row = clean.removed_rows(df, kept).first()
    assert (row.rows_before, row.rows_after, row.removed) == (5, 3, 2)
    assert profile.profile_duplicates(df.drop("id")).first().duplicate_rows == 2


def test_one_row_repeated_many_times(spark, row_width):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"))
    assert clean.dedup_rows(df).count() == 2001


def test_nulls_and_nans(spark):
    df = spark.createDataFrame([(1.0, None), (math.nan, "a"), (None, "b")], "d double, s string")
    got = {r.column_name: (r.null_count, r.total_nulls) for r in profile.profile_nulls(df).collect()}
    assert got == {"d": (2, 3), "s": (1, 3)}
    full = df.na.drop()
    assert profile.profile_nulls(full).count() == 0
    assert profile.profile_nulls(full, only_missing=False).count() == 2


def test_interactions_skip_missing_columns(spark):
    df = spark.createDataFrame([(2.0, 3.0, 4.0)], "v1 double, v4 double, v11 double")
    assert features.feat_interactions(df).columns == ["v1", "v4", "v11", "v4_v11_interact"]
    assert features.feat_interactions(df.select("v1")).columns == ["v1"]


def test_flag_is_strict(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "amount double")
    assert _column(features.feat_high_value_flag(df, threshold=2.0), "high_value_flag") == [0, 0, 1]


def test_clip(spark):
    df = spark.createDataFrame([(-9.0,), (0.0,), (99.0,), (None,)], "amount_zscore double")
    assert _column(features.feat_clip(df), "amount_zscore") == [-3.0, 0.0, 10.0, None]


def test_feature_pipeline_has_35_features(spark, sf_small):
    table = features.feature_pipeline(fixtures.transactions(spark, sf_small))
    assert features.feature_count(table) == 35
    assert "time_seconds" not in table.columns and "amount" not in table.columns
    stats = table.agg(F.avg("amount_zscore"), F.stddev_pop("amount_zscore")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1, abs=1e-9)


def test_narrow_and_full_fixture_agree(spark, sf_check):
    cols = ["id", "time_seconds", "amount", "class"]
    full = fixtures.transactions(spark, sf_check).select(cols)
    narrow = fixtures.transactions(spark, sf_check, vectors=False).select(cols)
    assert full.exceptAll(narrow).count() == 0 and narrow.exceptAll(full).count() == 0


def test_fixture_ignores_the_session_time_zone(spark, sf_small):
    before = fixtures.transactions(spark, sf_small, vectors=False).agg(F.sum("time_seconds")).first()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        after = fixtures.transactions(spark, sf_small, vectors=False).agg(F.sum("time_seconds")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after


def test_more_repeated_hashes_than_a_broadcast_takes(spark, monkeypatch):
    """Beyond the limit a Bloom filter keeps nearly all rows that occur once where they are."""
    df = spark.range(4000).selectExpr("id div 2 as a", *[f"id div 2 % {i + 2} as c{i}" for i in range(clean.WIDE_ROW)])
    df = df.unionByName(spark.range(20_000).selectExpr("-id - 1 as a", *[f"id % {i + 2} as c{i}" for i in range(clean.WIDE_ROW)]))
    want = df.distinct().count()
    monkeypatch.setattr(clean, "BROADCAST_KEYS", 1_500)
    single, repeated = clean.split_by_repetition(df)
    assert single.count() + repeated.count() == df.count()
    assert single.where("a >= 0").isEmpty() and single.count() > 19_000
    assert clean.dedup_rows(df).count() == want == 22_000
    monkeypatch.setattr(clean, "BROADCAST_KEYS", 3)
    assert clean.dedup_rows(df).count() == want


def test_compressed_csv_is_read_back_in_parts_of_a_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PART_ROWS", 10)
    rows = spark.range(95).selectExpr("id", "id / 7 as value").coalesce(1)
    path = str(tmp_path / "rows")
    files.save(rows, path, compression="gzip")
    parts = list((tmp_path / "rows").glob("*.csv.gz"))
    assert len(parts) == 10
    assert sorted(files.load_raw(spark, path, rows.schema).collect()) == sorted(rows.collect())


def test_splits_are_written_without_sorting_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    """With open files for each split a task need not hold its rows; the setting holds for this write alone."""
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    plain, before = DataFrameWriter.parquet, spark.conf.get(name)

    def parquet(writer, path, *args, **options):
        seen.append(int(spark.conf.get(name)))
        return plain(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    rows = spark.range(100).selectExpr("id", "if(id % 5 = 0, 'test', 'train') as split").coalesce(1)
    files.save_splits(rows, str(tmp_path / "splits"))
    assert seen == [8] and spark.conf.get(name) == before
    assert files.load_splits(spark, str(tmp_path / "splits"), "test").count() == 20
    assert files.load_splits(spark, str(tmp_path / "splits")).count() == 100
