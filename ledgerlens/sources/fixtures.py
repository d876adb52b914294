"""Labelled card transactions and scored tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import V_COLUMNS

# Planted class signal per vector position.
SIGNAL = {4: 0.08, 11: 0.08, 12: -0.12, 14: -0.15, 17: -0.18}


# Stated schemas: no job to read footers, and only these columns are in the scan.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, event_type string, value double",
    "embeddings": "vec_id bigint, embedding array<float>",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def class_of(event_type: Column, event_id: Column) -> Column:
    return F.when((event_type == "error") & (event_id % 7).isin(0, 1), 1).otherwise(0)


def transactions(spark: SparkSession, sf_dir: str, vectors: bool = True) -> DataFrame:
    """``id, time_seconds, [v1..v28,] amount, class``.

    ``vectors=False`` leaves out the V columns and with them the left join that brings them in.
    """
    events = _table(spark, sf_dir, "events")
    first = events.agg(F.min("ts")).scalar()
    seconds = (F.col("ts") - first).cast("interval second").cast("decimal(18,6)").cast("double")
    base = events.select(
        F.col("event_id").alias("id"),
        seconds.alias("time_seconds"),
        F.round(F.col("value") * 10, 2).alias("amount"),
        class_of(F.col("event_type"), F.col("event_id")).alias("class"),
    )
    if not vectors:
        return base
    embeddings = _table(spark, sf_dir, "embeddings")
    size = embeddings.agg(F.count(F.lit(1))).scalar()
    # The planner broadcasts the vectors only when their size is under its threshold.
    joined = base.withColumn("vec_id", F.col("id") % size).join(
        embeddings.select("vec_id", "embedding"), "vec_id", "left"
    )
    shifted = [
        f"cast(embedding[{i - 1}] as double) + class * {SIGNAL.get(i, 0.0)}D as {v}"
        for i, v in enumerate(V_COLUMNS, start=1)
    ]
    return joined.selectExpr("id", "time_seconds", *shifted, "amount", "class")


def transactions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No ``id``; every tenth row twice; a null amount on every 97th row."""
    table = transactions(spark, sf_dir)
    copies = F.when(F.col("id") % 10 == 0, 2).otherwise(1)
    dirty = table.withColumn("amount", F.when(F.col("id") % 97 != 0, F.col("amount")))
    return dirty.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy", "id")


def scored(spark: SparkSession, sf_dir: str, lift: int = 30) -> DataFrame:
    """Deterministic scores: ``id, label, prob, prediction`` with many ties."""
    rows = transactions(spark, sf_dir, vectors=False)
    prob = ((F.col("id") * 37) % 101 + F.lit(lift) * F.col("class")) / F.lit(float(101 + lift))
    table = rows.select("id", F.col("class").alias("label"), prob.alias("prob"))
    return table.withColumn("prediction", (F.col("prob") > 0.5).cast("int"))


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models in long form: ``model, position, id, label, prob, prediction``."""
    def one(name: str, position: int, lift: int) -> DataFrame:
        return scored(spark, sf_dir, lift).select(
            F.lit(name).alias("model"), F.lit(position).alias("position"), "id", "label", "prob", "prediction"
        )

    return one("Base", 1, 15).unionByName(one("Tuned", 2, 30))
