"""Language identification by a string kernel.

Two texts are compared by the n-grams (one to three bytes of their lower-cased UTF-8) that both have, whatever their
number: k(x, y) = |X and Y| / sqrt(|X| |Y|). Nyström landmarks stand for the training texts, and one ridge regression
per language over the kernel values tells it from the rest. A batch of texts is scored by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import labelled
from .words import raw, slices

BITS = 14
LANDMARKS = 128  # over all languages
TRAINING_ROWS = 8_000  # labelled texts that the regressions are fitted on at most; every text is scored
RIDGE = 1e-3
ROWS = 512  # texts in one matrix product at most
NO_LANGUAGE = "und"

_LETTER = regex.compile(r"\p{L}")
# Letters keep their byte (A to Z lower-cased), every other ASCII byte is one gap.
_CODE = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], dtype=np.uint32)
_FACTOR = np.uint32(0x9E3779B1)


def presence(texts: pa.Array) -> np.ndarray:
    """One row per text: 1 at each hashed n-gram that stands in it."""
    data, offsets = raw(texts)
    out = np.zeros((len(texts), 1 << BITS), dtype=np.uint8)
    if len(data):
        row = np.repeat(np.arange(len(texts)), np.diff(offsets))
        code, gram = _CODE[data], np.zeros(len(data), dtype=np.uint32)
        for n in range(1, 4):
            gram = gram[: len(data) - n + 1] * np.uint32(257) + code[n - 1 :] + np.uint32(n)
            inside = row[n - 1 :] == row[: len(data) - n + 1]
            at = ((gram * _FACTOR) >> np.uint32(32 - BITS)).astype(np.int64)
            out[row[: len(data) - n + 1][inside], at[inside]] = 1
    return out


def kernel(texts: pa.Array, landmarks: np.ndarray) -> np.ndarray:
    """Kernel values of texts (rows) with landmarks (columns); a text without n-grams has zeros."""
    found = presence(texts).astype(np.float32)
    size = found.sum(1, keepdims=True)
    return (found @ landmarks.T) / np.sqrt(np.maximum(size, 1) * np.maximum(landmarks.sum(1), 1))


def _runs(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    for at, texts in slices(column, 1 << 20):
        for more in range(0, len(texts), ROWS):
            yield at + more, texts.slice(more, ROWS)


def fit(df: DataFrame, label: str, usable: Column, key: str = "doc_id", text: str = "text") -> dict:
    """{languages, landmarks, weights} from at most ``TRAINING_ROWS`` rows with a label for which ``usable`` holds.

    Every language has the same number of rows (all of a rare one), weighed by what they stand for. Without any row there
    is no language. The sums that the regressions need are added up in the tasks; only they and the
    landmarks reach the driver.
    """
    picked, stands_for = labelled.sample_each(df, label, usable, key, TRAINING_ROWS)
    stands_for = {str(name): n for name, n in stands_for.items()}
    texts = labelled.sampled_texts(df, picked, key, [df[text].cast("string").alias("text")])
    texts = materialize(texts.select("text", F.col("label").cast("string").alias("language"), "order"), "language-sample")
    languages = sorted(r[0] for r in texts.select("language").distinct().collect())
    if not languages:
        return {"languages": [], "landmarks": np.zeros((0, 1 << BITS), np.float32), "weights": np.zeros((0, 0))}
    place = F.row_number().over(Window.partitionBy("language").orderBy("order"))
    numbered = texts.withColumn("place", place).where(F.col("place") <= max(1, LANDMARKS // len(languages)))
    chosen = numbered.orderBy("order").select("text")
    landmarks = presence(pa.array([r["text"] or "" for r in chosen.collect()], pa.string())).astype(np.float32)
    shared = df.sparkSession.sparkContext.broadcast(landmarks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        square = np.zeros((len(marks), len(marks)))
        right = np.zeros((len(marks), len(languages)))
        for batch in batches:
            for at, part in _runs(batch.column(0)):
                k = kernel(part, marks).astype(np.float64)
                told = batch.column(1).slice(at, len(part)).to_pylist()
                target = np.array([[1.0 if t == name else -1.0 for name in languages] for t in told])
                weighed = k * np.array([[stands_for[t]] for t in told])
                square += weighed.T @ k
                right += weighed.T @ target
        sums = np.concatenate([square.ravel(), right.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], ["sums"])

    training = texts.select("text", "language").repartition(labelled.SHARDS)
    total_weight = sum(stands_for[r["language"]] * r["count"] for r in texts.groupBy("language").count().collect())
    parts = [np.array(r["sums"]) for r in training.mapInArrow(run, "sums array<double>").collect()]
    total = np.sum(parts, axis=0)
    m = len(landmarks)
    square, right = total[: m * m].reshape(m, m), total[m * m :].reshape(m, -1)
    size = np.maximum(landmarks.sum(1), 1)
    between = (landmarks @ landmarks.T / np.sqrt(np.outer(size, size))).astype(np.float64)
    weights = np.linalg.solve(square + RIDGE * total_weight / m * between + 1e-6 * np.eye(m), right)
    return {"languages": languages, "landmarks": landmarks, "weights": weights.astype(np.float32)}


def predict(df: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, language, score), one row per input row.

    The language of the highest value, and that value from -1 to 1 moved to 0 to 1; ``und`` and 0 where the text is
    null, has no letter, or no language was learned. Of equal values the first language by name counts.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model["languages"], NO_LANGUAGE], dtype=object)
        for batch in batches:
            for at, part in _runs(batch.column(1)):
                plain = [t or "" for t in part.to_pylist()]
                lettered = np.array([bool(_LETTER.search(t)) for t in plain]) & (len(names) > 1)
                best, score = np.full(len(part), len(names) - 1), np.zeros(len(part))
                if lettered.any():
                    values = kernel(part, model["landmarks"]) @ model["weights"]
                    best = np.where(lettered, values.argmax(1), best)
                    score = np.where(lettered, (np.clip(values.max(1), -1, 1) + 1) / 2, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)),
                        pa.array(names[best].tolist(), pa.string()),
                        pa.array(score.astype(np.float64)),
                    ],
                    ["key", "language", "score"],
                )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, language string, score double")
