"""The corpus pipeline: quality filter, exact and near duplicates, benchmark passages, then token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import stages
from ledgerlens.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: In order; each takes the documents that the one before kept, and all but the last return the columns of documents.
STAGES: list[tuple[str, Stage]] = [
    ("quality", stages.quality),
    ("exact_dedup", stages.exact_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate_docs),
    ("tokens", stages.tokens),
]

#: A trained model and a probabilistic sketch stand in the way of SQL: tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is stored, so that the next reads and never recomputes it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def all_oracles() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
