"""Forests that no process holds whole, and nested forests: one deep fit answers for fewer trees, less depth and larger nodes.

A fitted forest is a stored table with one row for each tree, whose nodes are arrays of bytes. It is applied where rows and
trees meet: blocks of binned rows go to one task for every few trees, which holds these trees and adds up the shares of class
1; the sums of a block are added in the order of its trees. The driver has the number of nodes and the depth of each tree.

A tree that is grown greedily holds every shallower tree: a depth limit or a least number of rows to split a node only
stops the same splits earlier. So the class share of *every* node is kept, and one walk over a row gives the votes for all
prefixes of the forest, all depths and all split sizes at once.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import forget, scratch_path

CHUNK_TREES, MOST_CHUNKS = 10, 12  # trees that a task applies to a block, until there are so many chunks of them
DEEPEST = 64  # no tree is as deep
PROB = "prob"
_X = "_forest_x"

#: The stored table: one row for each tree.
NODES = "tree int, n int, depth int, walk binary, n0 binary, n1 binary, gain binary"


@dataclass(frozen=True)
class Nodes:
    """The nodes of one tree; 0 is the root and children come behind their parent. ``left`` and ``right`` are the node's own
    number in a leaf; a row goes left if its bin is at most ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    n0: np.ndarray  # rows of each class that reached the node when the tree was grown, as often as the tree drew them
    n1: np.ndarray
    gain: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return self.n0 + self.n1

    @property
    def share(self) -> np.ndarray:
        return self.n1 / np.maximum(self.rows, 1)

    @property
    def depth(self) -> int:
        depth, at = -1, np.array([0])
        while len(at):
            depth, at = depth + 1, at[self.left[at] != at]
            at = np.concatenate([self.left[at], self.right[at]])
        return depth

    def importance(self, size: int) -> np.ndarray:
        """Each feature's part of what the splits gained."""
        inner = self.left != np.arange(len(self.left))
        found = np.bincount(self.feature[inner], weights=(self.gain * self.rows)[inner], minlength=size)
        return found / found.sum() if found.sum() else found

    def cut_small(self, least: int) -> Nodes:
        """The tree whose nodes with fewer rows than ``least`` are leaves."""
        own = np.arange(len(self.left))
        inner = (self.left != own) & (self.rows >= least)
        kept = np.zeros(len(own), dtype=bool)
        at = np.array([0])
        while len(at):
            kept[at] = True
            at = at[inner[at]]
            at = np.concatenate([self.left[at], self.right[at]])
        new = np.cumsum(kept) - 1
        goes = inner[kept]
        place = lambda a: np.where(goes, new[a[kept]], new[kept])
        return Nodes(
            np.where(goes, self.feature[kept], 0), np.where(goes, self.cut[kept], 0), place(self.left), place(self.right),
            self.n0[kept], self.n1[kept], np.where(goes, self.gain[kept], -1.0),
        )

    def stored(self, tree: int) -> pa.Table:
        walk = [self.feature.astype(np.int16), self.cut.astype(np.int16), self.left.astype(np.int32), self.right.astype(np.int32)]
        blobs = [walk, [self.n0.astype(np.int64)], [self.n1.astype(np.int64)], [self.gain.astype(np.float64)]]
        cells = [pa.array([v], pa.int32()) for v in (tree, len(self.left), self.depth)]
        cells += [pa.array([b"".join(a.tobytes() for a in blob)], pa.binary()) for blob in blobs]
        return pa.table(cells, names=["tree", "n", "depth", "walk", "n0", "n1", "gain"])


def read_nodes(n: int, walk: pa.Buffer, n0: pa.Buffer, n1: pa.Buffer, gain: pa.Buffer | None = None) -> Nodes:
    small = np.frombuffer(walk, np.int16, 2 * n)
    large = np.frombuffer(walk, np.int32, 2 * n, 4 * n)
    gains = np.zeros(0) if gain is None else np.frombuffer(gain)
    return Nodes(small[:n], small[n:], large[:n], large[n:], np.frombuffer(n0, np.int64), np.frombuffer(n1, np.int64), gains)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Nodes]]:
    """The trees of rows of the stored table."""
    for batch in batches:
        for tree, n, *blobs in zip(*(batch.column(c) for c in ("tree", "n", "walk", "n0", "n1", "gain"))):
            yield tree.as_py(), read_nodes(n.as_py(), *(b.as_buffer() for b in blobs))


def placed(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of every value: value <= edges[bin], and the one behind the last edge for larger values."""
    bins = np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)])
    return bins.astype(_bin_kind(edges))


def _bin_kind(edges: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, edges)) < 256 else np.uint16


@dataclass(frozen=True)
class TreeFacts:
    """What the driver knows of a tree."""

    numNodes: int
    depth: int


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.nodes(self.sparkSession).write.mode("overwrite").parquet(f"{path}/trees")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> ForestModel:
        model = super().load(path)
        model.path = f"{path}/trees"
        return model


class ForestModel(Model, HasFeaturesCol, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol, MLReadable, MLWritable):
    """A fitted forest of two classes whose trees stay in the table at ``path``."""

    edges = Param(Params._dummy(), "edges", "upper bounds of the bins of each feature as JSON", TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "deepest level of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a leaf", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "features to choose from", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, edges: str = "[]", numTrees: int = 0, maxDepth: int = 0, minInstancesPerNode: int = 1,
        featureSubsetStrategy: str = "all", seed: int = 0,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", rawPredictionCol="rawPrediction", probabilityCol="probability", predictionCol="prediction")
        self._set(**self._input_kwargs)
        self.path = ""

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(NODES).parquet(self.path)

    def discard(self, spark: SparkSession) -> None:
        """Delete the trees of a model that is in the scratch folder."""
        forget(spark, self.path)

    @property
    def bin_edges(self) -> list[np.ndarray]:
        return [np.array(e, dtype=float) for e in json.loads(self.getOrDefault(self.edges))]

    @property
    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    @property
    def trees(self) -> list[TreeFacts]:
        told = self.nodes(SparkSession.active()).select("tree", "n", "depth").collect()
        return [TreeFacts(r["n"], r["depth"]) for r in sorted(told)]

    @property
    def totalNumNodes(self) -> int:
        return sum(t.numNodes for t in self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """The mean over the trees of what each feature's splits gained, adding up to 1."""
        size = len(self.bin_edges)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for tree, nodes in _trees(batches):
                cells = [pa.array([tree], pa.int32()), pa.array([nodes.importance(size).tolist()], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cells, ["tree", "parts"])

        told = self.nodes(SparkSession.active()).mapInArrow(run, "tree int, parts array<double>").collect()
        total = sum((np.array(r["parts"]) for r in sorted(told, key=lambda r: r["tree"])), np.zeros(size))
        return DenseVector(total / total.sum() if total.sum() else total)

    def scored(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """Columns ``keep`` of ``rows`` and ``prob``, the mean share of class 1 that the trees give a row."""
        count = self.getNumTrees
        vectors = [c for c in keep if isinstance(rows.schema[c].dataType, VectorUDT)]
        plain = rows.select(
            *[vector_to_array(c).alias(c) if c in vectors else F.col(f"`{c}`") for c in keep],
            vector_to_array(self.getFeaturesCol()).alias(_X),
        )

        def finish(table: pa.Table) -> pa.Table:
            table = table.sort_by("chunk")
            votes = sum(np.frombuffer(v.as_buffer()) for chunk in table.column("votes").chunks for v in chunk)
            return _unpacked(table.column("rows")[0].as_buffer()).append_column(PROB, pa.array(votes / count))

        told = _votes(self, _blocks(plain, self.bin_edges, keep), _chunks(count), [DEEPEST], [0])
        spark = rows.sparkSession
        tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        shape = T.StructType([f for f in plain.schema.fields if f.name != _X]).add(PROB, "double")
        out = told.repartition(tasks, "block").groupBy("block").applyInArrow(finish, shape)
        return out.withColumns({c: array_to_vector(c) for c in vectors})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p, count = F.col(PROB), F.lit(float(self.getNumTrees))
        return (
            self.scored(dataset, dataset.columns)
            .withColumns(
                {
                    self.getRawPredictionCol(): array_to_vector(F.array((1 - p) * count, p * count)),
                    self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
                    self.getPredictionCol(): F.when(p > 0.5, 1.0).otherwise(0.0),
                }
            )
            .drop(PROB)
        )

    def setRawPredictionCol(self, value: str) -> ForestModel:
        return self._set(rawPredictionCol=value)

    def setProbabilityCol(self, value: str) -> ForestModel:
        return self._set(probabilityCol=value)

    def setPredictionCol(self, value: str) -> ForestModel:
        return self._set(predictionCol=value)


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _blocks(rows: DataFrame, edges: list[np.ndarray], keep: list[str]) -> DataFrame:
    """(block, n, bins, rows): the rows of an Arrow batch, their bins and their columns ``keep``; a block's number is its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(b for b in batches if b.num_rows):
            x = batch.column(_X).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            cells = [
                pa.array([(part << 32) + number], pa.int64()),
                pa.array([batch.num_rows], pa.int32()),
                pa.array([placed(x, edges).tobytes()], pa.binary()),
                pa.array([_packed(batch.select(keep)) if keep else None], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(cells, ["block", "n", "bins", "rows"])

    return rows.mapInArrow(run, "block bigint, n int, bins binary, rows binary")


def _chunks(trees: int, ends: tuple[int, ...] = ()) -> list[int]:
    """The first tree of each chunk; it hangs on the forest alone, so sums do not change with the rows. A chunk ends at each
    of ``ends``."""
    step = max(CHUNK_TREES, math.ceil(trees / MOST_CHUNKS))
    return sorted({*range(0, trees, step), *(e for e in ends if e < trees)})


def _add_votes(
    total: dict[tuple[int, int], np.ndarray], n: int, root: int, left: np.ndarray, right: np.ndarray, share: np.ndarray,
    rows: np.ndarray, goes_left: Callable[[np.ndarray, np.ndarray], np.ndarray], depths: list[int], split_rows: list[int],
) -> None:
    """Add the shares of the nodes where ``n`` rows stop in one tree, for each depth and split size.

    A walk stops in a leaf, at the depth, or in a node with fewer rows than the split size.
    """
    for s in split_rows:
        at = np.full(n, root)
        moving = np.arange(n)
        for depth in range(depths[-1] + 1):
            if depth in depths:
                total[depth, s] += share[at]
            if not len(moving):
                continue
            node = at[moving]
            goes = (left[node] != node) & (rows[node] >= s)
            moving, node = moving[goes], node[goes]
            at[moving] = np.where(goes_left(moving, node), left[node], right[node])


def _votes(model: ForestModel, blocks: DataFrame, starts: list[int], depths: list[int], split_rows: list[int]) -> DataFrame:
    """(block, chunk, n, votes, rows): sums of shares over the trees of a chunk, (depth, split size, row) in this order; only
    the first chunk of a block has its ``rows``."""
    spark = blocks.sparkSession
    # every core gets some, and the trees are copied no more often than that takes
    groups = math.ceil(3 * spark.sparkContext.defaultParallelism / len(starts))
    depths = sorted(set(depths))
    keys = list(product(depths, split_rows))
    size, kind = len(model.bin_edges), _bin_kind(model.bin_edges)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = [], None
        for batch in batches:
            for place, of_rows, number, chunk, n, a, b, c in zip(*batch.columns):
                if place.as_py() != own:
                    held, own = [], place.as_py()
                n = n.as_py()
                if not of_rows.as_py():
                    nodes = read_nodes(n, a.as_buffer(), b.as_buffer(), c.as_buffer())
                    held.append((nodes, nodes.share, nodes.rows))
                    continue
                bins = np.frombuffer(a.as_buffer(), kind)
                total = {key: np.zeros(n) for key in keys}
                for nodes, share, rows in held:
                    goes_left = lambda at, node, f=nodes.feature, cut=nodes.cut: bins.take(at * size + f[node]) <= cut[node]
                    _add_votes(total, n, 0, nodes.left, nodes.right, share, rows, goes_left, depths, split_rows)
                votes = b"".join(total[key].tobytes() for key in keys)
                cells = [[number.as_py()], [chunk.as_py()], [n], [votes], [b.as_py()]]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cells, kinds)], ["block", "chunk", "n", "votes", "rows"])

    chunk = sum((F.when(F.col("tree") >= start, 1).otherwise(0) for start in starts[1:]), F.lit(0)).cast("int")
    place = (F.col("group") * len(starts) + F.col("chunk")).cast("int").alias("place")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    trees = (
        model.nodes(spark)
        .withColumn("chunk", chunk)
        .withColumn("group", every(groups))
        .select(place, F.lit(0).alias("of_rows"), F.col("tree").cast("bigint").alias("number"), "chunk", "n", "walk", "n0", "n1")
    )
    sent = (
        blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
        .withColumn("chunk", every(len(starts)))
        .select(
            place, F.lit(1).alias("of_rows"), F.col("block").alias("number"), "chunk", "n", F.col("bins").alias("walk"),
            F.when(F.col("chunk") == 0, F.col("rows")).alias("n0"), F.lit(None).cast("binary").alias("n1"),
        )
    )
    met = trees.union(sent).repartitionById(groups * len(starts), F.col("place")).sortWithinPartitions("place", "of_rows", "number")
    return met.mapInArrow(vote, "block bigint, chunk int, n int, votes binary, rows binary")


def stored_forest(spark: SparkSession, model: RandomForestClassificationModel | ForestModel) -> ForestModel:
    """A forest that Spark's own trainer fitted (so it is on the driver), for numeric features and two classes, as a table."""
    if isinstance(model, ForestModel):
        return model
    written = scratch_path(spark, "forest")
    model.write().overwrite().save(written)
    node = F.col("nodeData")
    table = spark.read.parquet(f"{written}/data").select(
        "treeID",
        node["id"].alias("id"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["impurityStats"][0].cast("bigint").alias("n0"),
        node["impurityStats"][1].cast("bigint").alias("n1"),
        node["gain"].alias("gain"),
    )
    used = table.where("left >= 0").groupBy("feature").agg(F.array_sort(F.collect_set("threshold")).alias("t")).collect()
    found = {r["feature"]: r["t"] for r in used}  # as many as a feature has bins
    edges = [np.array(found.get(f, [0.0])) for f in range(model.numFeatures)]

    def one(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")  # 0, 1, ... without gaps
        get = lambda name: rows.column(name).to_numpy()
        own, leaf = get("id"), get("left") < 0
        feature = np.where(leaf, 0, get("feature"))
        cuts = [0 if out else np.searchsorted(edges[f], t) for out, f, t in zip(leaf, feature, rows.column("threshold").to_pylist())]
        nodes = Nodes(feature, np.array(cuts), np.where(leaf, own, get("left")), np.where(leaf, own, get("right")), get("n0"), get("n1"), get("gain"))
        return nodes.stored(rows.column("treeID")[0].as_py())

    out = ForestModel(
        edges=json.dumps([e.tolist() for e in edges]), numTrees=model.getNumTrees, maxDepth=model.getOrDefault("maxDepth"),
        minInstancesPerNode=model.getOrDefault("minInstancesPerNode"),
        featureSubsetStrategy=model.getOrDefault("featureSubsetStrategy"),
    )
    out.path = scratch_path(spark, "forest-trees")
    table.groupBy("treeID").applyInArrow(one, NODES).write.parquet(out.path)
    return out


@dataclass(frozen=True)
class FlatForest:
    """Nodes of all trees: ``root`` of each tree; ``left`` is the node's own number in a leaf, then ``feature`` is 0."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray  # of class 1 among the node's rows
    rows: np.ndarray  # that reached the node when the tree was grown, as often as the tree drew them


def flatten(spark: SparkSession, model: RandomForestClassificationModel | ForestModel) -> FlatForest:
    """The arrays of a small forest on the driver, to look at its trees."""
    forest = stored_forest(spark, model)
    edges = forest.bin_edges
    trees = [nodes for _, nodes in sorted(_trees(forest.nodes(spark).toArrow().to_batches()), key=lambda t: t[0])]
    first = np.cumsum([0, *(len(t.left) for t in trees)])[:-1]
    joined = lambda parts: np.concatenate(list(parts))
    return FlatForest(
        root=first,
        feature=joined(t.feature for t in trees),
        threshold=joined(np.array([edges[f][c] for f, c in zip(t.feature, t.cut)]) for t in trees),
        left=joined(t.left + at for t, at in zip(trees, first)),
        right=joined(t.right + at for t, at in zip(trees, first)),
        share=joined(t.share for t in trees),
        rows=joined(t.rows for t in trees),
    )


def nested_votes(
    forest: FlatForest, x: np.ndarray, trees: list[int], depths: list[int], split_rows: list[int]
) -> dict[tuple[int, int, int], np.ndarray]:
    """{(number of trees, depth, least rows to split): sum of class-1 shares of the rows ``x``}, for all combinations."""
    depths = sorted(set(depths))
    total = {(d, s): np.zeros(len(x)) for d, s in product(depths, split_rows)}
    goes_left = lambda at, node: x[at, forest.feature[node]] <= forest.threshold[node]
    out = {}
    for number, root in enumerate(forest.root.tolist(), start=1):
        _add_votes(total, len(x), root, forest.left, forest.right, forest.share, forest.rows, goes_left, depths, split_rows)
        if number in trees:
            for (d, s), votes in total.items():
                out[number, d, s] = votes.copy()
    return out


def count_recalls(
    model: RandomForestClassificationModel | ForestModel,
    rows: DataFrame,
    trees: list[int],
    depths: list[int],
    split_rows: list[int],
    label: str = "class",
) -> dict[tuple[int, int, int], tuple[int, int]]:
    """{(trees, depth, split size): (found, all) rows of class 1}, in one pass over ``rows`` (features vector, label)."""
    spark = rows.sparkSession
    forest = stored_forest(spark, model)
    starts = _chunks(forest.getNumTrees, tuple(trees))
    depths = sorted(set(depths))
    keys = list(product(depths, split_rows))
    names = ["trees", "depth", "split_rows", "found", "wanted"]

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        votes = [np.frombuffer(v.as_buffer()) for chunk in table.column("votes").chunks for v in chunk]
        total, out = np.zeros(len(votes[0])), []
        for part, end in zip(votes, [*starts[1:], forest_trees]):
            total = total + part
            if end in trees:
                found = (total.reshape(len(keys), -1) > end / 2).sum(axis=1)  # the other class gets the rest of the votes
                out += [(end, d, s, f, total.size // len(keys)) for (d, s), f in zip(keys, found.tolist())]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], names=names)

    forest_trees = forest.getNumTrees
    positive = rows.where(F.col(label) == 1).select(vector_to_array("features").alias(_X))
    told = _votes(forest, _blocks(positive, forest.bin_edges, []), starts, depths, split_rows)
    counted = told.groupBy("block").applyInArrow(count, ", ".join(f"{n} bigint" for n in names))
    sums = counted.groupBy(names[:3]).agg(*[F.sum(c).alias(c) for c in names[3:]]).collect()
    return {(r["trees"], r["depth"], r["split_rows"]): (r["found"], r["wanted"]) for r in sums}


def cut_small_nodes(spark: SparkSession, model: RandomForestClassificationModel | ForestModel, least: int) -> ForestModel:
    """The forest as it would be if a node needed ``least`` rows to be split: smaller nodes become leaves."""
    forest = stored_forest(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, nodes in _trees(batches):
            yield from nodes.cut_small(least).stored(tree).to_batches()

    cut = forest.copy()
    cut.path = scratch_path(spark, "forest-cut")
    forest.nodes(spark).mapInArrow(run, NODES).write.parquet(cut.path)
    return cut
