"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and the L1 term keeps most weights at exactly zero, so the model that is
sent to the executors is a short list of weights. A feature counts once for a text, however often it stands there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, stored_while
from . import labelled
from .labelled import Shard, State, sigmoid
from .words import ALNUM, mix, slices, word_hashes

BITS = 24  # hash space of the features
ALPHA, BETA, L1, L2 = 2.0, 1.0, 2.0, 0.0
ROUNDS = 8
ROWS = 512  # feature rows that a task handles at once
RANGES = 64  # parts of the hash space that features are counted in
SKIP_SEED, PAIR_SEED = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of every word, neighbouring pair and pair with one word between, as they stand in the texts."""
    values, counts = word_hashes(texts, ALNUM)
    row = np.repeat(np.arange(len(counts)), counts)
    rows, found = [row], [values]
    for distance, seed in ((1, PAIR_SEED), (2, SKIP_SEED)):
        if len(values) > distance:
            same = np.flatnonzero(row[distance:] == row[:-distance])
            rows.append(row[same])
            found.append(mix(values[same] * seed + values[same + distance]))
    index = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate(rows), index


def _different(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different features of each text, in order."""
    row, index = features(texts)
    both = np.unique((row << BITS) | index)
    return both >> BITS, both & ((1 << BITS) - 1)


def weights(state: State, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Weights of coordinates from their gradient sums and squared sums."""
    z, n = state["z"][at], state["n"][at]
    rate = (BETA + np.sqrt(n)) / ALPHA + L2
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)


def _train(shard: Shard, state: State, number: int) -> State:
    """One pass of FTRL-proximal over the rows of a shard; the last coordinate is the bias, without L1."""
    z, n = state["z"], state["n"]  # changed in place: a shard's copy
    bias = len(z) - 1
    order = np.random.default_rng(number).permutation(len(shard.label))
    for i in order.tolist():
        at = shard.index[shard.begins[i] : shard.ends[i]]
        w = weights(state, at)
        b = -z[bias] / ((BETA + np.sqrt(n[bias])) / ALPHA)
        g = float(sigmoid(w.sum() + b)) - float(shard.label[i])
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g
        z[bias] += g - (np.sqrt(n[bias] + g * g) - np.sqrt(n[bias])) / ALPHA * b
        n[bias] += g * g
    return state


def fit(df: DataFrame, labels: DataFrame, label: str, usable: Column, key: str = "doc_id", text: str = "text") -> dict:
    """The sparse model {bias, index, weight}, from at most ``SAMPLE_ROWS`` labelled rows for which ``usable`` holds.

    Without any the bias is zero and there are no weights.
    """
    picked = labelled.sample(labels, label, usable, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(0), 1 << 20):
                row, index = _different(texts)
                stops = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(2).slice(at, len(texts)),
                        batch.column(1).slice(at, len(texts)).cast(pa.float32()),
                        pa.ListArray.from_arrays(pa.array(stops), pa.array(index.astype(np.int32))),
                        pa.array([[]] * len(texts), pa.list_(pa.float32())),
                    ],
                    ["order", "label", "index", "dense"],
                )

    rows = labelled.sampled_texts(df, picked, key, [df[text].cast("string").alias("text")])
    schema = labelled.ROWS
    with stored_while(rows.mapInArrow(run, schema), "toxicity-features") as made:
        frequent, size, shards = _shards(made, schema)
    start = {name: np.zeros(size + 1, dtype=np.float32) for name in ("z", "n")}
    state = labelled.fit(shards, start, _train, ROUNDS)
    some = np.flatnonzero(np.abs(state["z"][:-1]) > L1)
    w = weights({name: values[some].astype(np.float64) for name, values in state.items()})
    bias = -float(state["z"][-1]) / ((BETA + float(state["n"][-1]) ** 0.5) / ALPHA)
    return {"bias": float(bias), "index": _numbers(frequent)[some].astype(np.int32), "weight": w.astype(np.float32)}


def _dense(model: dict) -> np.ndarray:
    """The weight of every coordinate of the hash space."""
    out = np.zeros(1 << BITS, dtype=np.float32)
    out[model["index"]] = model["weight"]
    return out


def _shards(made: DataFrame, schema: str) -> tuple[DataFrame, int, DataFrame]:
    """The features that may get a weight and their number, and the rows ``made`` as shards, with these features numbered.

    The driver holds the features only while they are sent, not while it averages models.
    """
    trained_rows = made.count()
    frequent = _frequent(made, _least_rows(made, trained_rows))
    kept = _numbers(frequent)
    shared = made.sparkSession.sparkContext.broadcast(kept)

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, dtype=np.int32)
        place[shared.value] = np.arange(len(shared.value), dtype=np.int32)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            lists = batch.column("index")
            index = place[lists.flatten().to_numpy(zero_copy_only=False)]
            sums = np.concatenate([[0], np.cumsum(index >= 0)])
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            stops = sums[np.concatenate([[0], ends])].astype(np.int32)
            fewer = pa.ListArray.from_arrays(pa.array(stops), pa.array(index[index >= 0]))
            columns = [batch.column("order"), batch.column("label"), fewer, batch.column("dense")]
            yield pa.RecordBatch.from_arrays(columns, ["order", "label", "index", "dense"])

    shards = labelled.pack(made.mapInArrow(renumber, schema), trained_rows)
    shared.destroy()
    return frequent, len(kept), shards


def _least_rows(made: DataFrame, rows: int) -> int:
    """2 if no feature of a single row can get a weight, so that leaving these out changes nothing; 1 otherwise.

    As long as a feature has no weight, a visit to its row moves z by less than 1, and the average takes a shard's share
    of that. So z stays within L1 at the row's last visit and at the end if these bounds do.
    """
    sizes = [r["count"] for r in made.groupBy(labelled.shard_of(rows)).count().collect()]
    bounds = [0.0]
    for n in sizes:
        visits = labelled.passes(n)
        step = visits * n / sum(sizes)
        bounds += [ROUNDS * step, (ROUNDS - 1) * step + visits - 1]
    return 2 if max(bounds) <= L1 else 1


def _frequent(made: DataFrame, least: int) -> DataFrame:
    """Stored (found): the features that stand in at least ``least`` rows of the sample, counted range by range in tasks."""
    wide = (1 << BITS) // RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, dtype=np.uint8)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                index = batch.column(0).slice(begin, ROWS).flatten().to_numpy(zero_copy_only=False)
                at, seen = np.unique(index, return_counts=True)
                counts[at] = np.minimum(counts[at] + seen, least)
        packed = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(RANGES, wide)]
        yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array(packed, pa.binary())], ["range", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(wide, dtype=np.uint32)
        for part in table.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(part), dtype=np.uint8)
        found = (np.flatnonzero(total >= least) + table.column("range")[0].as_py() * wide).astype(np.int32)
        return pa.table({"found": pa.array([found.tobytes()], pa.binary())})

    counted = made.select("index").mapInArrow(count, "range int, counts binary")
    return materialize(counted.groupBy("range").applyInArrow(add, "found binary"), "frequent-features")


def _numbers(frequent: DataFrame) -> np.ndarray:
    """All features of ``_frequent``, in order."""
    found = [np.frombuffer(r["found"], dtype=np.int32) for r in frequent.collect()]
    return np.sort(np.concatenate(found or [np.zeros(0, dtype=np.int32)]))


def score(df: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score), one row per input row: the probability of the label. Null and empty texts get the bias alone."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = _dense(model)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                row, index = features(texts)
                told = np.flatnonzero(dense[index])
                both = np.unique((row[told] << BITS) | index[told])
                sums = np.bincount(both >> BITS, weights=dense[both & ((1 << BITS) - 1)], minlength=len(texts))
                scores = sigmoid(sums + model["bias"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(scores)], ["key", "score"])

    kind = df.schema[key].dataType.simpleString()
    narrow = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"key {kind}, score double")
