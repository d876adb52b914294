"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

score = w0 + sum(w x) + 1/2 sum_f((sum v_f x)^2 - sum(v_f^2 x^2)): all pairwise interactions in linear time, since the
square of a sum holds every pair twice and every feature's own square once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import labelled
from .labelled import Shard, State, sigmoid
from .marks import text_hash
from .words import ALNUM, NOT_SPACE, bounds, hashes, raw, slices

BITS = 16
FACTORS = 8
RATE, DECAY, BATCH = 0.1, 1e-5, 64
ROUNDS = 8

_ASCII = np.arange(256)
_KINDS = {
    "upper": (_ASCII >= 65) & (_ASCII <= 90),
    "lower": (_ASCII >= 97) & (_ASCII <= 122),
    "digit": (_ASCII >= 48) & (_ASCII <= 57),
    "space": ~NOT_SPACE,
    "line": _ASCII == 10,
    "beyond": _ASCII >= 128,
    "mark": (_ASCII > 32) & (_ASCII < 127) & ~ALNUM,
    "stop": np.isin(_ASCII, [ord(c) for c in ".,;:"]),
}
STATISTICS = [
    "bytes", "words", "word_length", *_KINDS, "different", "top_word", "repeated", "lines", "different_lines",
    "marked_words", "rows",
]


def _rows_of(starts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(np.searchsorted(starts, offsets))
    return counts, np.repeat(np.arange(len(counts)), counts)


def _share_different(values: np.ndarray, row: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the share of different values, and the share of the most frequent one."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(v)))
    top = np.zeros(len(counts))
    np.maximum.at(top, r[at], size)
    most = np.maximum(counts, 1)
    return np.bincount(r[at], minlength=len(counts)) / most, top / most


def features(texts: pa.Array, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index) of the different hashed words of each text, and a dense row of statistics and metadata for each.

    ``metadata`` is the given number of characters, not a number where unknown.
    """
    data, offsets = raw(texts)
    size = np.diff(offsets)
    starts, ends = bounds(data, offsets, ALNUM)
    counts, row = _rows_of(starts, offsets)
    values = hashes(data, starts, ends)
    index = np.unique((row << BITS) | (values >> np.uint64(64 - BITS)).astype(np.int64))
    some, most = np.maximum(size, 1), np.maximum(counts, 1)
    by_row = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])
    stats = [np.log1p(size), np.log1p(counts), np.bincount(row, ends - starts, len(size)) / most]
    stats += [by_row(table[data]) / some for table in _KINDS.values()]
    different, top = _share_different(values, row, counts)
    again = np.zeros(len(values), dtype=bool)
    again[1:] = (values[1:] == values[:-1]) & (row[1:] == row[:-1])
    stats += [different, top, np.bincount(row[again], minlength=len(size)) / most]
    line_starts, line_ends = bounds(data, offsets, _ASCII != 10)
    line_counts, line_row = _rows_of(line_starts, offsets)
    line_hash = hashes(data, line_starts, line_ends)
    stats += [np.log1p(line_counts), _share_different(line_hash, line_row, line_counts)[0]]
    token_starts, token_ends = bounds(data, offsets, NOT_SPACE)
    token_counts, token_row = _rows_of(token_starts, offsets)
    odd = _KINDS["mark"] & ~_KINDS["stop"]
    marks = np.concatenate([[0], np.cumsum(odd[data], dtype=np.int64)])
    marked = marks[token_ends] > marks[token_starts]
    stats += [np.bincount(token_row[marked], minlength=len(size)) / np.maximum(token_counts, 1)]
    stats += [np.where(np.isnan(metadata), np.log1p(size), np.log1p(np.maximum(metadata, 0)))]
    return index >> BITS, index & ((1 << BITS) - 1), np.column_stack(stats).astype(np.float32)


def _forward(state: State, row, index, dense, rows: int):
    """Scores of rows, with what the gradient needs. A text's words have length one together."""
    count = np.bincount(row, minlength=rows)
    value = (1.0 / np.sqrt(np.maximum(count, 1)))[row].astype(np.float32)
    x = np.clip((dense - state["mean"]) / state["std"], -4, 4)
    vw = state["v"][index] * value[:, None]
    summed = x @ state["vd"]
    squares = (x * x) @ (state["vd"] * state["vd"])
    np.add.at(summed, row, vw)
    np.add.at(squares, row, vw * vw)
    linear = state["w0"][0] + x @ state["wd"] + np.bincount(row, state["w"][index] * value, rows)
    return linear + 0.5 * (summed * summed - squares).sum(1), x, value, vw, summed


def _train(shard: Shard, state: State, number: int) -> State:
    """One pass of mini-batches with per-parameter rates over the rows of a shard."""
    state = {name: values.copy() for name, values in state.items()}
    order = np.random.default_rng(number).permutation(len(shard.label))
    for at in range(0, len(order), BATCH):
        rows = order[at : at + BATCH]
        size = shard.ends[rows] - shard.begins[rows]
        row = np.repeat(np.arange(len(rows)), size)
        index = np.concatenate([shard.index[shard.begins[i] : shard.ends[i]] for i in rows.tolist()])
        y, x, value, vw, summed = _forward(state, row, index, shard.dense[rows], len(rows))
        error = (sigmoid(y) - shard.label[rows]).astype(np.float32) / len(rows)
        grads = {
            "w0": np.array([error.sum()], dtype=np.float32),
            "wd": x.T @ error + DECAY * state["wd"],
            "vd": x.T @ (error[:, None] * summed) - state["vd"] * ((x * x).T @ error)[:, None] + DECAY * state["vd"],
        }
        for name, g in grads.items():
            state["g_" + name] += g * g
            state[name] -= RATE * g / np.sqrt(state["g_" + name] + 1e-8)
        each, where = np.unique(index, return_inverse=True)
        gw = np.bincount(where, error[row] * value, len(each)).astype(np.float32)
        gv = np.zeros((len(each), FACTORS), dtype=np.float32)
        np.add.at(gv, where, (error[row] * value)[:, None] * (summed[row] - vw))
        for name, g in (("w", gw), ("v", gv)):
            state["g_" + name][each] += g * g
            state[name][each] -= RATE * g / np.sqrt(state["g_" + name][each] + 1e-8)
    return state


def start_state(mean: np.ndarray, std: np.ndarray) -> State:
    """Untrained parameters for dense features of that mean and deviation."""
    rng = np.random.default_rng(5)
    dense = len(mean)
    state = {
        "w0": np.zeros(1, dtype=np.float32),
        "w": np.zeros(1 << BITS, dtype=np.float32),
        "v": rng.normal(0, 0.01, (1 << BITS, FACTORS)).astype(np.float32),
        "wd": np.zeros(dense, dtype=np.float32),
        "vd": rng.normal(0, 0.01, (dense, FACTORS)).astype(np.float32),
    }
    state.update({"g_" + name: np.zeros_like(values) for name, values in list(state.items())})
    state["mean"], state["std"] = mean.astype(np.float32), std.astype(np.float32)
    return state


def _columns(df: DataFrame, text: str, metadata: str | None) -> list[Column]:
    known = df[metadata].cast("double") if metadata and metadata in df.columns else F.lit(None).cast("double")
    return [df[text].cast("string").alias("text"), known.alias("metadata")]


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def fit(
    df: DataFrame, labels: DataFrame, label: str, usable: Column, key: str = "doc_id", text: str = "text", metadata: str | None = "n_chars"
) -> State:
    """The trained model, from at most ``SAMPLE_ROWS`` labelled rows for which ``usable`` holds.

    Without any, every text gets about one half.
    """
    picked = labelled.sample(labels, label, usable, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(0), 1 << 20):
                n = len(texts)
                row, index, dense = features(texts, _numbers(batch.column(1).slice(at, n)))
                stops = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                wide = np.arange(n + 1, dtype=np.int32) * dense.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(3).slice(at, n),
                        batch.column(2).slice(at, n).cast(pa.float32()),
                        pa.ListArray.from_arrays(pa.array(stops), pa.array(index.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(wide), pa.array(dense.ravel())),
                    ],
                    ["order", "label", "index", "dense"],
                )

    rows = labelled.sampled_texts(df, picked, key, _columns(df, text, metadata))
    shards = labelled.pack(rows.mapInArrow(run, labelled.ROWS), picked.count())
    wide = len(STATISTICS)
    flat = shards.select(F.posexplode("dense").alias("at", "x")).groupBy(F.pmod("at", F.lit(wide)).alias("at"))
    moments = {r["at"]: r for r in flat.agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std")).collect()}
    mean = np.array([moments[i]["mean"] if i in moments else 0.0 for i in range(wide)])
    std = np.array([max(moments[i]["std"], 1e-3) if i in moments else 1.0 for i in range(wide)])
    state = labelled.fit(shards, start_state(mean, std), _train, ROUNDS)
    return {name: values for name, values in state.items() if not name.startswith("g_")}


def score(
    df: DataFrame, model: State, key: str = "doc_id", text: str = "text", metadata: str | None = "n_chars"
) -> DataFrame:
    """(key, score, text_hash), one row per input row: the probability that a text is good. Null counts as empty."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        for batch in batches:
            for at, texts in slices(batch.column(0), 2 << 20):
                n = len(texts)
                row, index, dense = features(texts, _numbers(batch.column(1).slice(at, n)))
                found = sigmoid(_forward(state, row, index, dense, n)[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(at, n), pa.array(found.astype(np.float64)), batch.column(3).slice(at, n)],
                    ["key", "score", "text_hash"],
                )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(*_columns(df, text, metadata), F.col(key).alias("key"), text_hash(F.col(text)))
    return rows.mapInArrow(run, f"key {kind}, score double, text_hash bigint")
