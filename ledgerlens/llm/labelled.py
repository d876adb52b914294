"""Fitting on a bounded sample of labelled rows, by averaging models that shards train side by side."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope

SAMPLE_ROWS = 20_000  # labelled rows that a model is fitted on at most; every row is scored
SHARDS = 8  # models trained side by side in each round at most
SHARD_ROWS = 1_000  # rows that a shard should have; with fewer rows there are fewer shards
ROUND_ROWS = 2_000  # row visits of a shard in a round at least, by up to ten passes over its rows

PART = 1 << 18  # numbers of a model that travel together

State = dict[str, np.ndarray]

#: Columns of feature rows: order and label of the sampled row, its sparse features, its dense ones.
ROWS = "order bigint, label float, index array<int>, dense array<float>"


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``."""
    return (F.crc32(key.cast("string")) % parts).cast("int")


def sample(labels: DataFrame, label: str, usable: Column, key: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(sample_key, label, order): at most ``rows`` labelled keys, picked by a hash of the key; all of them if fewer.

    Null keys and labels are left out; of several labels for one key the largest counts.
    """
    wanted = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & usable)
    one = wanted.groupBy(F.col(key).alias("sample_key")).agg(F.max(F.col(label)).alias("label"))
    ordered = one.withColumn("order", F.xxhash64("sample_key")).orderBy("order", "sample_key").limit(rows)
    return materialize(ordered, "label-sample")


def sample_each(labels: DataFrame, label: str, usable: Column, key: str, rows: int) -> tuple[DataFrame, dict]:
    """As ``sample``, with the same number of keys for every label (all of a rare one), and what a key of each stands for.

    So a label is learned however rare it is; the weights restore the labels' shares.
    """
    wanted = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & usable)
    one = wanted.groupBy(F.col(key).alias("sample_key")).agg(F.max(F.col(label)).alias("label"))
    one = materialize(one.withColumn("order", F.xxhash64("sample_key")), "labelled-keys")
    sizes = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    most = max(1, rows // max(1, len(sizes)))
    place = F.row_number().over(Window.partitionBy("label").orderBy("order", "sample_key"))
    picked = one.withColumn("place", place).where(F.col("place") <= most).drop("place")
    return materialize(picked, "label-sample"), {k: n / min(n, most) for k, n in sizes.items()}


def shard_of(rows: int) -> Column:
    """The shard of a sampled row, of ``rows`` in all."""
    return F.pmod("order", F.lit(max(1, min(SHARDS, rows // SHARD_ROWS))))


def passes(rows: int) -> int:
    """Passes of a shard over its rows in one round."""
    return max(1, min(10, ROUND_ROWS // max(1, rows)))


def pack(features: DataFrame, rows: int) -> DataFrame:
    """Store ``rows`` feature rows (order, label, index array<int>, dense array<float>) as one row for each shard."""

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("order").combine_chunks()
        index, dense = (table.column(c).combine_chunks() for c in ("index", "dense"))
        ends = np.cumsum(pa.compute.list_value_length(index).to_numpy(zero_copy_only=False))
        whole = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.table(
            {
                "shard": table.column("shard")[:1],
                "label": whole(table.column("label").to_pylist(), pa.float32()),
                "ends": whole(ends.astype(np.int64), pa.int64()),
                "index": whole(index.flatten().to_numpy(zero_copy_only=False), pa.int32()),
                "dense": whole(dense.flatten().to_numpy(zero_copy_only=False), pa.float32()),
            }
        )

    schema = "shard bigint, label array<float>, ends array<bigint>, index array<int>, dense array<float>"
    sharded = features.withColumn("shard", shard_of(rows))
    return materialize(sharded.groupBy("shard").applyInArrow(one, schema), "training-shards")


class Shard:
    """The rows of one shard: row i has the features ``index[begin:end]`` and ``dense[i]``."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)
        self.label, self.ends, self.index = get("label"), get("ends"), get("index")
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        dense = get("dense")
        self.dense = dense.reshape(len(self.label), len(dense) // max(1, len(self.label)))


def to_bytes(state: State) -> dict[str, tuple[bytes, tuple[int, ...]]]:
    """Each array of 32-bit numbers, packed, with its shape."""
    return {name: (zlib.compress(np.ascontiguousarray(v, dtype=np.float32).data, 1), v.shape) for name, v in state.items()}


def from_bytes(packed: dict[str, tuple[bytes, tuple[int, ...]]]) -> State:
    return {name: np.frombuffer(zlib.decompress(d), dtype=np.float32).reshape(shape).copy() for name, (d, shape) in packed.items()}


def changes(now: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The bits in which 32-bit numbers differ from those before: zero, which packs to almost nothing, where they are kept."""
    return now.ravel().view(np.uint32) ^ before.ravel().view(np.uint32)


def fit(shards: DataFrame, start: State, train: Callable[[Shard, State, int], State], rounds: int) -> State:
    """Rounds of training: each shard goes on from the last average; the average weighs shards by their rows.

    Without rows the start is returned. A shard gives the bits that it changed, stored in parts. One part at a time
    reaches the driver and is added up, shard after shard.
    """
    spark = shards.sparkSession
    state = {name: values.astype(np.float32) for name, values in start.items()}
    sizes = {r["shard"]: r["n"] for r in shards.select("shard", F.size("label").alias("n")).collect()}
    if not sizes:
        return state
    share = {shard: np.float32(n / sum(sizes.values())) for shard, n in sizes.items()}
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(to_bytes(state))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    shard = Shard(batch, row)
                    now, before = from_bytes(shared.value), from_bytes(shared.value)
                    for again in range(passes(len(shard.label))):
                        now = train(shard, now, 100 * number + again)
                    told = batch.column("shard")[row].as_py()
                    for name, values in now.items():
                        flat = changes(values.astype(np.float32, copy=False), before[name])
                        for at in range(0, len(flat), PART):
                            packed = zlib.compress(flat[at : at + PART].tobytes(), 1)
                            cells = [[name], [at], [told], [packed]]
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names)

        names, kinds = ["name", "at", "shard", "data"], [pa.string(), pa.int64(), pa.int64(), pa.binary()]
        shape = "name string, at bigint, shard bigint, data binary"
        with scratch_scope(spark):
            made = materialize(shards.mapInArrow(run, shape), "shard-models")
            shared.destroy()
            del shared, run  # what was sent takes no room while the average is made
            total = {name: np.zeros_like(values) for name, values in state.items()}
            for told in sorted(sizes):  # in this order, so that sums do not depend on which shard ended first
                for row in made.where(F.col("shard") == told).select("name", "at", "data").coalesce(1).toLocalIterator():
                    changed = np.frombuffer(zlib.decompress(bytes(row["data"])), dtype=np.uint32)
                    part = slice(row["at"], row["at"] + len(changed))
                    before = state[row["name"]].reshape(-1)[part].view(np.uint32)
                    total[row["name"]].reshape(-1)[part] += (before ^ changed).view(np.float32) * share[told]
            state = total
    return state


def sampled_texts(df: DataFrame, picked: DataFrame, key: str, columns: list[Column]) -> DataFrame:
    """One row of ``df`` for each sampled key, with label and order: of rows with one key, the least.

    The sample is a bounded number of narrow rows, so it may be broadcast.
    """
    joined = df.join(F.broadcast(picked), df[key] == picked["sample_key"])
    rows = joined.select(F.struct(*columns).alias("row"), picked["label"], picked["order"])
    return rows.groupBy("order", "label").agg(F.min("row").alias("row")).select("row.*", "label", "order")


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
