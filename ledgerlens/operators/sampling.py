"""Stratified split and folds, and minority over-sampling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import HASH_SPACE, hash32
from ..plans.ordering import Cut, rank_cuts
from ..session import materialize
from ..sources.schema import FEATURES
from .neighbours import approximate_neighbours, nearest_neighbours

COPY_BLOCK = 10_000  # synthetic rows that one task grows from one base row at a time


def apportion(sizes: dict, share: float) -> dict:
    """Split ``ceil(share * n)`` over the classes by largest remainder."""
    total = sum(sizes.values())
    seats = math.ceil(round(share * total, 9))
    exact = {g: seats * n / total for g, n in sizes.items()}
    quota = {g: math.floor(v) for g, v in exact.items()}
    order = sorted(sizes, key=lambda g: (-(exact[g] - quota[g]), str(g)))
    for g in order[: seats - sum(quota.values())]:
        quota[g] += 1
    return quota


def _pick(label: str, cuts: dict[object, list[Cut]], hash_col: Column, tie_col: Column, value) -> Column:
    """``when`` chain over the classes; ``value`` turns a class's cuts into a column."""
    out = None
    for group, group_cuts in cuts.items():
        match = F.col(label) == F.lit(group)
        picked = value([c.covers(hash_col, tie_col) for c in group_cuts])
        out = F.when(match, picked) if out is None else out.when(match, picked)
    return out


def stratified_split(
    df: DataFrame,
    label: str = "class",
    test_size: float = 0.2,
    seed: int = 42,
    exact: bool = True,
    id_col: str = "id",
) -> DataFrame:
    """Add ``split`` (train/test); the test rows of a class are those with the lowest id hash.

    ``exact`` meets the class quotas to the row. Either way the assignment is a plain filter on the
    id: the table is not shuffled, and the same row always lands on the same side.
    """
    key = hash32(str(seed), F.col(id_col))
    if not exact:
        is_test = key < F.lit(int(test_size * HASH_SPACE))
    else:
        _, cuts = rank_cuts(df, key, id_col, label, lambda sizes: {g: [q] for g, q in apportion(sizes, test_size).items()})
        is_test = _pick(label, cuts, F.col("_h"), F.col(id_col), lambda covered: covered[0])
    hashed = df.withColumn("_h", key)
    return hashed.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_h")


def _fold_ends(n: int, k: int) -> list[int]:
    """Row ranks where the first k-1 folds end; the first n % k folds hold one row more."""
    small, extra = divmod(n, k)
    ends, at = [], 0
    for i in range(k - 1):
        at += small + (1 if i < extra else 0)
        ends.append(at)
    return ends


def stratified_kfold(
    df: DataFrame, label: str = "class", k: int = 5, seed: int = 42, keys: tuple[str, ...] = ("id",), out: str = "fold"
) -> DataFrame:
    """Add ``fold`` 0..k-1; each class is spread evenly (sizes differ by at most one row)."""
    tie = F.concat_ws(":", *[F.col(c).cast("string") for c in keys]) if len(keys) > 1 else F.col(keys[0])
    keyed = df.withColumn("_tie", tie).withColumn("_h", hash32(f"{seed}:fold", *[F.col(c) for c in keys]))
    _, cuts = rank_cuts(
        keyed, F.col("_h"), "_tie", label, lambda sizes: {g: _fold_ends(n, k) for g, n in sizes.items()}
    )

    def number(covered: list[Column]) -> Column:
        past = [F.when(c, 0).otherwise(1) for c in covered]
        total = F.lit(0)
        for p in past:
            total = total + p
        return total

    return keyed.withColumn(out, _pick(label, cuts, F.col("_h"), F.col("_tie"), number)).drop("_h", "_tie")


def _minority_points(df: DataFrame, features: list[str], label: str, minority: int, id_col: str) -> DataFrame:
    values = ", ".join(f"cast(`{c}` as double)" for c in features)
    points = df.where(F.col(label) == minority).selectExpr(f"`{id_col}` as id", f"array({values}) as x")
    return materialize(points, "minority")


def smote_knn(
    df: DataFrame,
    features: list[str] = FEATURES,
    label: str = "class",
    minority: int = 1,
    k: int = 5,
    id_col: str = "id",
    method: str = "exact",
    **options,
) -> DataFrame:
    """``id, rank, neighbour_id, distance``: the k nearest minority rows of each minority row.

    ``method="lsh"`` looks only into shared hash buckets and may miss some.
    """
    points = _minority_points(df, features, label, minority, id_col)
    search = {"exact": nearest_neighbours, "lsh": approximate_neighbours}[method]
    return search(points, k, **options).withColumnRenamed("id", id_col)


def smote(
    df: DataFrame,
    features: list[str] = FEATURES,
    label: str = "class",
    minority: int = 1,
    k: int = 5,
    ratio: float = 1.0,
    seed: int = 42,
    id_col: str = "id",
    **options,
) -> DataFrame:
    """Add synthetic minority rows ``x + u * (neighbour - x)`` until minority = ratio * majority.

    Every minority row is the base of the same number of synthetic rows (the rows with the lowest
    id hash get one more), so nothing is joined or shuffled at the size of the output. Neighbour and
    ``u`` are drawn from a hash of (base id, number). Integer features are truncated. Returns the
    input's id, label and features with ``copy_no`` (0 = original) and ``is_synthetic``.
    """
    types = dict(df.dtypes)
    original = df.select(id_col, label, *features).withColumns(
        {"copy_no": F.lit(0).cast("bigint"), "is_synthetic": F.lit(False)}
    )
    sizes = {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}
    rows = sizes.get(minority, 0)
    majority = max((n for g, n in sizes.items() if g != minority), default=0)
    missing = int(ratio * majority) - rows
    if missing <= 0:
        return original
    points = _minority_points(df, features, label, minority, id_col)
    near = materialize(nearest_neighbours(points, k, **options), "neighbours")
    # A neighbour at distance 0 is the point itself, so copies of one row need no join on its id.
    apart = near.where("distance > 0").join(
        points.select(F.col("id").alias("neighbour_id"), F.col("x").alias("nx")), "neighbour_id"
    )
    same = near.where("distance = 0").withColumn("nx", F.lit(None).cast("array<double>"))
    cols = ["id", "rank", "nx"]
    gathered = (
        apart.select(cols)
        .unionByName(same.select(cols))
        .groupBy("id")
        .agg(F.map_from_entries(F.collect_list(F.struct("rank", "nx"))).alias("near"))  # k entries
    )
    share, extra = divmod(missing, rows)
    key = hash32(f"{seed}:base", F.col("id"))
    _, cuts = rank_cuts(
        points.withColumn("_g", F.lit(0)), key, "id", "_g", lambda _: {0: [extra]}
    )
    takes = F.lit(share) + F.when(cuts[0][0].covers(F.col("_h"), F.col("id")), 1).otherwise(0)
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bases = (
        points.join(gathered, "id")
        .withColumn("_h", key)
        .withColumn("_take", takes.cast("bigint"))
        .where("_take > 0")
    )
    # In two steps: blocks of numbers are spread over the tasks before each grows its own rows.
    last = F.floor((F.col("_take") - 1) / COPY_BLOCK)
    blocks = bases.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    blocks = blocks.repartition(spread, "id", "_block")
    start = F.col("_block") * COPY_BLOCK + 1
    grown = blocks.withColumn("copy_no", F.explode(F.sequence(start, F.least(F.col("_take"), start + COPY_BLOCK - 1))))
    rank = hash32(f"{seed}:neighbour", F.col("id"), F.col("copy_no")) % k + 1
    step = hash32(f"{seed}:step", F.col("id"), F.col("copy_no")) / F.lit(float(HASH_SPACE))
    drawn = grown.select(
        "id",
        "copy_no",
        "x",
        F.coalesce(F.try_element_at("near", rank.cast("int")), F.col("x")).alias("nx"),
        step.alias("u"),
    )
    values = [
        f"cast(x[{i}] + u * (nx[{i}] - x[{i}]) as {types[c]}) as `{c}`" for i, c in enumerate(features)
    ]
    synthetic = drawn.selectExpr(
        f"id as `{id_col}`",
        f"cast({minority} as {types[label]}) as `{label}`",
        *values,
        "copy_no",
        "true as is_synthetic",
    )
    return original.unionByName(synthetic)


def resampled_splits(df: DataFrame, features: list[str] = FEATURES, label: str = "class", test_size: float = 0.2, seed: int = 42, **options) -> DataFrame:
    """Split first, then over-sample the train rows only: features + ``split, copy_no, is_synthetic``."""
    parted = stratified_split(df, label, test_size, seed)
    train = smote(parted.where("split = 'train'"), features, label, seed=seed, **options)
    test = parted.where("split = 'test'").select("id", label, *features, "split")
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumns({"copy_no": F.lit(0).cast("bigint"), "is_synthetic": F.lit(False)})
    )


def class_balance_report(splits: DataFrame, label: str = "class") -> DataFrame:
    """Rows per stage, split and class, before and after over-sampling, in one pass."""
    counted = splits.groupBy("split", label).agg(
        F.count_if(~F.col("is_synthetic")).alias("before"), F.count(F.lit(1)).alias("after")
    )
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("n")) for s in ("before", "after")])
    return counted.select(F.inline(stages), "split", label).select("stage", "split", label, "n")


def split_sizes(splits: DataFrame, label: str = "class") -> DataFrame:
    """Rows and positive share per split."""
    return splits.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(label).cast("bigint").alias("fraud_rows"),
        F.round(F.avg(label).cast("decimal(28,10)"), 6).cast("double").alias("fraud_ratio"),
    )
