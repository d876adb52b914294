"""The stages of the corpus pipeline: each takes documents and returns the rows that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import bpe, decontaminate, exact_dup, near_dup, quality as quality_classifier
from .marks import drop_marked
from .queries import quality_model, vocabulary_path

KEEP_FROM = 0.3  # score from which a document is good enough
NEAR = (80, 100)  # similarity from which documents are near duplicates; op6 has its own figure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts have a score like others; of rows with one key, those with a rejected text go, repeated rows
    together. Without labels every text gets about one half and stays.
    """
    scored = quality_classifier.score(docs, quality_model(spark, sf_dir))
    marks = scored.select("key", "text_hash", (F.col("score") >= KEEP_FROM).alias("kept"))
    return drop_marked(docs, materialize(marks, "quality-marks"), "doc_id", "text")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays: the one with the largest doc_id."""
    return exact_dup.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the smallest doc_id."""
    return near_dup.drop_near_duplicates(docs, threshold=NEAR)


def decontaminate_docs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words in benchmark passages go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and digests of ids and of the text decoded from them.

    Null and empty texts have no tokens; repeated rows and keys give a row each.
    """
    return bpe.digest(docs, vocabulary_path(), with_ids=True)
