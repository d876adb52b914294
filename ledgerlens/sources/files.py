"""Readers and writers: CSV, table, splits, models, report sections."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import RAW_SCHEMA, V_COLUMNS

PART_ROWS = 100_000  # rows of a part file of compressed CSV
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def load_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Read a CSV with a header and a stated schema; a malformed row fails the read."""
    return spark.read.schema(schema).options(header=True, mode="FAILFAST").csv(path)


def raw_to_transactions(df: DataFrame) -> DataFrame:
    """Raw column names to the table's lower-case names."""
    return df.select(
        F.col("Time").alias("time_seconds"),
        *[F.col(v.upper()).alias(v) for v in V_COLUMNS],
        F.col("Amount").alias("amount"),
        F.col("Class").alias("class"),
    )


def transactions_to_raw(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("time_seconds").alias("Time"),
        *[F.col(v).alias(v.upper()) for v in V_COLUMNS],
        F.col("amount").alias("Amount"),
        F.col("class").alias("Class"),
    )


def save(df: DataFrame, path: str, fmt: str = "csv", compression: str | None = None) -> None:
    """Write a folder of part files; CSV parts carry a header. Missing parents are created.

    Compressed CSV cannot be split, so its parts hold at most ``PART_ROWS`` rows: that many tasks can read them.
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    if compression:
        writer = writer.option("compression", compression)
        if fmt == "csv":
            writer = writer.option("maxRecordsPerFile", PART_ROWS)
    writer.format(fmt).save(path)


def register_table(df: DataFrame, name: str = "transactions") -> DataFrame:
    """Make ``df`` addressable from SQL and return the named table."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_splits(splits: DataFrame, path: str) -> None:
    """One folder per split, so loading one side reads only its files.

    A task writes the few folders side by side: it need not hold and sort its rows by split first.
    """
    conf = splits.sparkSession.conf
    before = conf.get(_WRITERS, None)
    conf.set(_WRITERS, "8")
    try:
        splits.write.mode("overwrite").partitionBy("split").parquet(path)
    finally:
        conf.unset(_WRITERS) if before is None else conf.set(_WRITERS, before)


def load_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if split is None else table.where(F.col("split") == split)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_report(sections: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each section table to its own folder; returns the folders."""
    paths = {}
    for name, table in sections.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        save(table, paths[name], fmt)
    return paths


def load_report(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: spark.read.format(fmt).load(path) for name, path in paths.items()}
