"""Keep the rows of a table that a narrow table of marks tells to keep."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def few_tasks(df: DataFrame, rows: int, per_task: int) -> DataFrame:
    """``df`` (at most ``rows`` rows) in no more tasks than ``per_task`` rows for each call for."""
    return df.coalesce(max(1, math.ceil(rows / per_task)))


def text_hash(text: Column) -> Column:
    """With a key, tells rows apart that share the key."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def keep_marked(df: DataFrame, marks: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``df`` that ``marks`` (key, text_hash, kept; one row per row of ``df``) keeps, all columns as they are.

    Only rows to leave out, or with a repeated key and text, are looked up: of a repeated row, one stays if any may.
    """
    each = marks.groupBy("key", "text_hash").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    each = materialize(each.where("n > 1 OR NOT kept"), "changed")

    def matches(listed: DataFrame) -> Column:
        return df[key].eqNullSafe(listed["key"]) & (text_hash(df[text]) == listed["text_hash"])

    out = df.join(each, matches(each), "left_anti")
    repeated = each.where("kept")
    if not repeated.isEmpty():
        again = df.join(repeated, matches(repeated), "left_semi")
        extra = "_".join(["hash", *df.columns])  # a name that no column has
        again = again.withColumn(extra, text_hash(F.col(text))).dropDuplicates([key, extra])
        out = out.unionByName(again.drop(extra))
    return out


def drop_marked(df: DataFrame, marks: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``df`` that ``marks`` (key, text_hash, kept) does not leave out; repeated rows stay or go together."""
    out = marks.where(~F.col("kept")).select("key", "text_hash").distinct()
    told = df[key].eqNullSafe(out["key"]) & (text_hash(df[text]) == out["text_hash"])
    return df.join(out, told, "left_anti")
