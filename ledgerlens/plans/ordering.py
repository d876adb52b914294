"""Global order without a single-task sort: indexes, running totals, rank cuts."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from ..functions.numeric import HASH_SPACE
from ..session import materialize

ROW_LIMIT = 1_000_000
MAX_BUCKETS = 8192
SAMPLE_PER_BUCKET = 50
# monotonically_increasing_id keeps the row number inside a partition in its low 33 bits.
_LOW_BITS = (1 << 33) - 1


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_index(df: DataFrame, order: list[str], out: str = "rn", partitions: int | None = None) -> DataFrame:
    """Add a dense 0-based index in the order of ``order`` (which must be a total order).

    Rows are range partitioned, so a hot leading key is split by the next one; the ranges are
    written once because a second evaluation could draw other range bounds.
    """
    n = partitions or _partitions(df)
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)))
    )
    placed = materialize(placed, "index")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition.
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_pos"))
        .drop("_part", "_pos", "_offset")
    )


def rolling_sum(
    df: DataFrame,
    value: str,
    order: list[str],
    n: int,
    out: str,
    partitions: int | None = None,
) -> DataFrame:
    """``sum(value)`` (null counts as 0) over the current and the ``n - 1`` rows before it, over the whole table.

    Rows are shuffled once, into sorted ranges that are summed as they pass. What the first rows of a range miss are the
    last ``n - 1`` rows before it, of one or several ranges: a broadcast of at most that many rows for each range.
    """
    if n < 1:
        raise ValueError("a frame has at least one row")
    halo = n - 1
    whole = df.schema[value].dataType.typeName() in ("byte", "short", "integer", "long")
    kind = "bigint" if whole else "double"
    ranges = partitions or _partitions(df)
    sorted_ = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    named = sorted_.withColumn("_v", F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        before = np.zeros(halo, dtype="int64" if whole else "float64")
        for batch in batches:
            values = np.concatenate([before, batch.column("_v").to_numpy()])
            sums = np.lib.stride_tricks.sliding_window_view(values, n).sum(axis=1) if batch.num_rows else values[:0]
            before = values[len(values) - halo :]
            places = np.arange(at, at + batch.num_rows)
            at += batch.num_rows
            columns = [pa.array(np.full(batch.num_rows, part)), pa.array(places), pa.array(sums)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "_part", "_pos", out])

    shape = StructType([*named.schema.fields])
    for name, type_ in (("_part", LongType()), ("_pos", LongType()), (out, LongType() if whole else DoubleType())):
        shape = shape.add(name, type_)
    summed = materialize(named.mapInArrow(run, shape), "ranges")
    if not halo:
        return summed.drop("_part", "_pos", "_v")
    sizes = summed.groupBy("_part").agg(F.max("_pos").alias("_last"))
    ends = summed.select("_part", "_pos", "_v").join(F.broadcast(sizes), "_part").where(F.col("_pos") > F.col("_last") - halo)
    # at most n - 1 rows of each range; its first one sees all that came before the range
    earlier = Window.orderBy("_part", "_pos").rowsBetween(-halo, -1)
    first = F.col("_pos") == F.greatest(F.lit(0), F.col("_last") - halo + 1)
    seen = ends.withColumn("_before", F.reverse(F.collect_list("_v").over(earlier))).where(first).select("_part", "_before")
    # the rows right before this one within its range are in its sum already
    missing = F.slice("_before", 1, F.greatest(F.lit(0), F.lit(halo) - F.col("_pos")).cast("int"))
    added = F.aggregate(missing, F.lit(0).cast(kind), lambda total, v: total + v)
    joined = summed.join(F.broadcast(seen), "_part")
    return joined.withColumn(out, F.when(F.col("_pos") < halo, F.col(out) + added).otherwise(F.col(out))).drop(
        "_part", "_pos", "_v", "_before"
    )


def running_totals(
    counts: DataFrame,
    key: str,
    sums: list[str],
    by: list[str] | None = None,
    descending: bool = False,
    limit: int = ROW_LIMIT,
    range_col: str | None = None,
) -> DataFrame:
    """Add ``cum_<name>`` for each of ``sums``, in the order of the double column ``key``.

    ``counts`` has one row per (by, key), without null or NaN keys; it is written once, so its input is
    scanned once. Rows go to key ranges of about ``limit`` rows, and the totals of earlier ranges are
    added. ``range_col`` keeps the range number.
    """
    by = by or []
    direction = F.desc if descending else F.asc
    counts = materialize(counts, "totals")
    total = counts.count()
    buckets = min(MAX_BUCKETS, math.ceil(total / limit) + 1)
    # A bounded sample places the range bounds; they only decide how even the ranges are.
    share = min(1.0, buckets * SAMPLE_PER_BUCKET / max(1, total))
    sample = counts.select(key).sample(share, seed=42).limit(2 * buckets * SAMPLE_PER_BUCKET).collect()
    keys = sorted(row[0] for row in sample)
    cuts = {keys[i * len(keys) // buckets] for i in range(1, buckets)} if keys else set()
    edges = [-math.inf, *sorted(c for c in cuts if math.isfinite(c)), 0.0, math.inf]
    edges = sorted(set(edges))
    placed = Bucketizer(splits=edges, inputCol=key, outputCol="_bucket").transform(counts)
    per_bucket = placed.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    before = Window.partitionBy(*by).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    # At most MAX_BUCKETS rows per group.
    offsets = per_bucket.select(
        *by, "_bucket", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_before_{s}") for s in sums]
    )
    inside = (
        Window.partitionBy(*by, "_bucket").orderBy(direction(key)).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = placed.withColumns({f"cum_{s}": F.sum(s).over(inside) for s in sums}).join(
        F.broadcast(offsets), [*by, "_bucket"]
    )
    total_cols = {f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_before_{s}") for s in sums}
    done = summed.withColumns(total_cols).drop(*[f"_before_{s}" for s in sums])
    return done.withColumnRenamed("_bucket", range_col) if range_col else done.drop("_bucket")


@dataclass(frozen=True)
class Cut:
    """The first ``rank`` rows of a group are those with (hash, tie) <= (hash, tie)."""

    rank: int
    hash: int
    tie: object = None

    def covers(self, hash_col: Column, tie_col: Column) -> Column:
        if self.tie is None:
            return hash_col <= F.lit(self.hash)
        return (hash_col < F.lit(self.hash)) | (
            (hash_col == F.lit(self.hash)) & (tie_col <= F.lit(self.tie))
        )


_NOTHING, _EVERYTHING = -1, HASH_SPACE
_FIRST_BITS, _NEXT_BITS = 10, 11


def rank_cuts(
    df: DataFrame, hash_col: Column, tie: str, by: str, ranks: Callable[[dict], dict[object, list[int]]]
) -> tuple[dict, dict[object, list[Cut]]]:
    """Exact rank thresholds over a 32-bit hash, so "the lowest r rows per group" is a plain filter.

    Each scan counts rows per hash prefix (at most 2,048 counters per group, then per cut) and keeps the
    prefix that holds the wanted rank; two or three scans replace a sort of the table. ``by`` is a label
    with few values; ``ranks`` maps the group sizes to the wanted ranks. Returns (sizes, cuts).
    """
    keyed = df.select(F.col(by).alias("g"), hash_col.alias("h"), F.col(tie).alias("t"))
    shift = 32 - _FIRST_BITS
    counted = _prefix_counts(keyed, shift)
    sizes: dict = {}
    for group, rows in counted.items():
        sizes[group] = sum(rows.values())
    wanted = ranks(sizes)
    cuts: dict = {}
    # (group, rank) -> (prefix, rank inside it, its rows)
    open_ranks = {}
    for group, ks in wanted.items():
        cuts[group] = [Cut(k, _NOTHING if k <= 0 else _EVERYTHING) for k in ks if k <= 0 or k >= sizes.get(group, 0)]
        for k in ks:
            if 0 < k < sizes.get(group, 0):
                open_ranks[(group, k)] = _locate(counted[group], k)
    while open_ranks and shift:
        old, few = shift, max(n for _, _, n in open_ranks.values()) <= 1 << _NEXT_BITS
        shift = 0 if few else max(0, shift - _NEXT_BITS)
        prefixes = sorted({(group, at[0]) for (group, _), at in open_ranks.items()}, key=str)
        hit = F.lit(False)
        for group, prefix in prefixes:
            hit = hit | ((F.col("g") == F.lit(group)) & (F.shiftright("h", old) == prefix))
        counted = _prefix_counts(keyed.where(hit), shift)
        for (group, k), (prefix, left, _) in open_ranks.items():
            inside = {b: n for b, n in counted[group].items() if b >> (old - shift) == prefix}
            open_ranks[(group, k)] = _locate(inside, left)
    for (group, k), (h, left, n) in open_ranks.items():
        last = None
        if left < n:  # rows that share the hash are split by the tie column
            same = keyed.where((F.col("g") == F.lit(group)) & (F.col("h") == h))
            last = same.orderBy("t").limit(left).agg(F.max("t")).first()[0]
        cuts[group].append(Cut(k, h, last))
    return sizes, {g: sorted(cs, key=lambda c: c.rank) for g, cs in cuts.items()}


def _prefix_counts(keyed: DataFrame, shift: int) -> dict[object, dict[int, int]]:
    out: dict = {}
    grouped = keyed.groupBy("g", F.shiftright("h", shift).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    for row in grouped.collect():
        out.setdefault(row.g, {})[row.b] = row.n
    return out


def _locate(counts: dict[int, int], rank: int) -> tuple[int, int, int]:
    """The key that holds the 1-based ``rank``: (key, rank inside it, its rows)."""
    before = 0
    for key in sorted(counts):
        if rank <= before + counts[key]:
            return key, rank - before, counts[key]
        before += counts[key]
    raise ValueError("rank beyond the counted rows")
