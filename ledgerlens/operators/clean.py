"""Cleaning, projection and filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Largest set of repeated-row keys, or of words of their Bloom filter (8 bytes each), that may be broadcast.
BROADCAST_KEYS = 4_000_000
BLOOM_BITS, BLOOM_BITS_PER_KEY = 4, 12
# Rows with fewer columns are hardly wider than their hash and are grouped directly.
WIDE_ROW = 8


def row_hash(cols: list[str]) -> Column:
    """8-byte hash of a row; different rows may share it."""
    return F.xxhash64(*cols)


def _bloom_place(hash_col: Column, words: int) -> tuple[Column, Column]:
    """(word, mask): where a hash stands in a Bloom filter of 64-bit words; all its bits lie in one word."""
    mask = F.lit(0).cast("bigint")
    for i in range(BLOOM_BITS):
        bit = F.pmod(F.xxhash64(hash_col, F.lit(i)), F.lit(64)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return F.pmod(hash_col, F.lit(words)), mask


def _bloom_filter(keys: DataFrame, count: int) -> tuple[DataFrame, int]:
    """((word, bits), number of words) of all ``keys`` (_h): built in each partition, merged bit by bit."""
    words = max(1, min(BROADCAST_KEYS, count * BLOOM_BITS_PER_KEY // 64))
    word, mask = _bloom_place(F.col("_h"), words)
    return keys.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits")), words


def split_by_repetition(
    df: DataFrame, cols: list[str] | None = None, hash_col: str | None = None
) -> tuple[DataFrame | None, DataFrame]:
    """Split into (rows that certainly occur once, rows that may repeat).

    Only an 8-byte row hash is shuffled to find the hashes seen more than once. While those fit a checked broadcast, the
    wide rows outside them never move. More of them go into a Bloom filter of bounded size: rows outside it occur once
    and stay, a row that it takes for a repeated one by mistake only moves in vain. Narrow rows are not split: the first
    part is None. ``hash_col`` names a column that already holds the hash.
    """
    if len(cols or df.columns) < WIDE_ROW:
        return None, df
    wanted = F.col(hash_col) if hash_col else row_hash(cols or df.columns)
    keys = df.select(wanted.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(keys.where("_n > 1").select("_h"), "repeated")
    count = repeated.count()
    hashed = df if hash_col == "_h" else df.withColumn("_h", wanted)
    if count <= BROADCAST_KEYS:
        small = F.broadcast(repeated)
        return hashed.join(small, "_h", "left_anti").drop("_h"), hashed.join(small, "_h", "left_semi").drop("_h")
    built, words = _bloom_filter(repeated, count)
    word, mask = _bloom_place(F.col("_h"), words)
    known = F.broadcast(materialize(built, "bloom"))
    marked = hashed.withColumns({"_word": word, "_mask": mask}).join(known, "_word", "left")
    held = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    extra = ["_h", "_word", "_mask", "_bits"]
    return marked.where(~held).drop(*extra), marked.where(held).drop(*extra)


def dedup_rows(df: DataFrame, id_col: str | None = None, hash_col: str | None = None) -> DataFrame:
    """Drop rows equal in all columns (nulls compare equal), keeping one.

    With ``id_col`` the other columns are compared and the smallest id is kept. ``hash_col`` names a
    column with ``row_hash`` of the compared columns; it is not part of the result.
    """
    out = [c for c in df.columns if c != hash_col]
    cols = [c for c in out if c != id_col]
    if hash_col is None and len(cols) >= WIDE_ROW:
        # The input is evaluated once: finding repeats reads only the stored hash.
        hash_col = "_h"
        df = materialize(df.withColumn(hash_col, row_hash(cols)), "staged")
    single, repeated = split_by_repetition(df, cols, hash_col)
    repeated = repeated.select(out)
    if id_col is None:
        kept = repeated.dropDuplicates()
    else:
        kept = repeated.groupBy(*cols).agg(F.min(id_col).alias(id_col)).select(out)
    return kept if single is None else single.select(out).unionByName(materialize(kept, "kept"))


def removed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before, after and removed."""
    old = before.agg(F.count(F.lit(1)).alias("rows_before"))
    new = after.agg(F.count(F.lit(1))).scalar()
    return old.withColumn("rows_after", new).withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def fit_scaler(df: DataFrame, col: str = "amount") -> tuple[float, float]:
    """(mean, population standard deviation) as plain numbers, to 12 digits: sums of doubles hang on their order in the last."""
    row = df.agg(F.avg(col), F.stddev_pop(col)).first()
    return tuple(None if v is None else float(f"{v:.12g}") for v in row)


def scaled(value: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd == 0, value - value).otherwise(F.try_divide(value - mean, sd))


def standard_scale(
    df: DataFrame,
    col: str = "amount",
    out: str = "amount_scaled",
    fit_on: DataFrame | None = None,
    stats: tuple[float, float] | None = None,
) -> DataFrame:
    """``(x - mean) / population std``; 0 where the std is 0.

    Without ``stats`` mean and std are a one-row subquery over ``fit_on`` (default: ``df``).
    """
    if stats is not None:
        mean, sd = F.lit(stats[0]), F.lit(stats[1])
    else:
        fitted = (df if fit_on is None else fit_on).agg(
            F.struct(F.avg(col).alias("mean"), F.stddev_pop(col).alias("sd"))
        ).scalar()
        mean, sd = fitted["mean"], fitted["sd"]
    return df.withColumn(out, scaled(F.col(col).cast("double"), mean, sd))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*cols)


def reorder_label_last(df: DataFrame, label: str = "class") -> DataFrame:
    return df.select([c for c in df.columns if c != label] + [label])


def filter_class(df: DataFrame, value: int, label: str = "class") -> DataFrame:
    return df.where(F.col(label) == value)
