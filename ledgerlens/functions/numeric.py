"""Numeric rules every operator shares: rounding, safe ratios, hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, returned as double.

    Values too large for a decimal with ten places have no digits to round and pass through, as infinities and NaN do.
    """
    number = value.cast("double")
    rounded = F.round(value.try_cast("decimal(28,10)"), digits).cast("double")
    return F.coalesce(rounded, number)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator * 100 / denominator`` rounded half up; null when the denominator is 0."""
    scaled = numerator.cast("double") * F.lit(100.0)
    return half_up(F.try_divide(scaled, denominator.cast("double")), digits)


def hash32(tag: str, *keys: Column) -> Column:
    """First 32 bits of ``md5(tag:key[:key...])`` as bigint: uniform, seeded, plan independent."""
    text = F.concat_ws(":", F.lit(tag), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def is_missing(df_types: dict[str, str], name: str) -> Column:
    """True for null, and for NaN in floating-point columns."""
    col = F.col(name)
    if df_types[name] in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return col.isNull()
