"""The prefix trie of rebuilt conversations, by composable fingerprints.

A conversation is rebuilt as the first turns of another one (its base) with its own later turns behind them. The
fingerprint of a sequence of turns is a product in a monoid: (length, hash) with (m, a)(n, b) = (m + n, a r^n + b) modulo
2^127 - 1, so the fingerprint of every prefix of a rebuilt conversation follows from those of the base's head and of its
own turns, and no rebuilt text is ever made.

1. Turns get a place in the order of all conversations and a mark, the hash of role and text; all turns of a mark are
   compared with each other, so a mark refers to one content.
2. Chunks (a conversation in a run of ``CHUNK`` places) are multiplied up, then the products of the chunks in front are
   combined in a logarithmic number of passes: a conversation of any length is many small rows.
3. Rows (conversation, depth) of one fingerprint are a node. Its members must agree in the mark of their last turn and in
   the fingerprint of their parent, so by induction in all turns; if any node does not, the work is done again with
   another base r.
4. The smallest member of a node owns it. What an owner owns is one path, so sums over a subtree are sums along the path
   and over the paths that hang from it. Each path knows the paths above it from its own rows: no walk over levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ordering import with_global_index
from ..session import materialize
from .repair import streamed

CHUNK = 256  # turns of a conversation that are multiplied together
PIECE = 4096  # conversation ids that are joined at once
PATH_BLOCK = 4096  # depths of a path that are summed together
P = 2**127 - 1
ATTEMPTS = 5


def base_of(seed: int) -> int:
    """The multiplier r of an attempt."""
    return int.from_bytes(hashlib.sha256(f"base {seed}".encode()).digest()[:16], "big") % (P - 2) + 2


def element(mark: str) -> int:
    return int(mark, 16) % P


def product(left: tuple[int, int], right: tuple[int, int], r: int) -> tuple[int, int]:
    """The fingerprint (length, hash) of a sequence made of two."""
    return left[0] + right[0], (left[1] * pow(r, right[0], P) + right[1]) % P


def suffix(whole: tuple[int, int], head: tuple[int, int], r: int) -> tuple[int, int]:
    """The fingerprint of what stands behind ``head`` in ``whole``."""
    n = whole[0] - head[0]
    return n, (whole[1] - head[1] * pow(r, n, P)) % P


def to_bytes(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _number(value: bytes | None) -> int:
    return int.from_bytes(value or b"", "big")


def turns(df: DataFrame, conv: str, turn: str, role: str, text: str, seed: int) -> tuple[DataFrame, bool]:
    """Stored (conv, place, block, mark, tokens), and whether every mark stands for one role and text.

    The order of a conversation is turn (null first), role, text; null roles and texts are empty. Null conversations are
    left out.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")
    )
    placed = with_global_index(rows, ["conv", "turn", "role", "text"], "place")
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.length("role").cast("string"), "role", "text"))
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    told = placed.select(
        "conv", "place", F.floor(F.col("place") / CHUNK).alias("block"), mark.alias("mark"),
        words.cast("long").alias("tokens"), F.struct("role", "text").alias("content"),
    )
    several = told.groupBy("mark").agg((F.min("content") == F.max("content")).alias("same")).where("NOT same")
    return materialize(told.drop("content"), "turns"), several.isEmpty()


def prefixes(rows: DataFrame, r: int) -> DataFrame:
    """Stored (conv, at, hash, mark, tokens): the fingerprint of the first ``at`` turns of each conversation, from 1."""
    chunk = rows.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", "mark", "tokens"))).alias("rows")
    )
    chunk = materialize(chunk, "chunks")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, total = [], []
            for marks in batch.column(2).to_pylist():
                value = 0
                for mark in marks:
                    value = (value * r + element(mark)) % P
                size.append(len(marks))
                total.append(to_bytes(value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(total, pa.binary())],
                ["conv", "block", "size", "hash"],
            )

    shape = "conv bigint, block bigint, size bigint, hash binary"
    totals = chunk.select("conv", "block", "rows.mark").mapInArrow(multiply, shape)
    totals = materialize(totals, "chunk-products")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, total = [], []
            for row in batch.to_pylist():
                n, value = product((row["s"] or 0, _number(row["h"])), (row["size"], _number(row["hash"])), r)
                size.append(n)
                total.append(to_bytes(value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(total, pa.binary())],
                ["conv", "block", "size", "hash"],
            )

    def behind(table: DataFrame, away: int) -> DataFrame:
        """``totals`` as seen from the chunk ``away`` chunks on."""
        return table.select("conv", (F.col("block") + away).alias("block"), F.col("size").alias("s"), F.col("hash").alias("h"))

    spans = totals.groupBy("conv").agg((F.max("block") - F.min("block")).alias("n")).agg(F.max("n")).first()[0] or 0
    away = 1
    while away <= spans:  # a chunk's product then covers up to 2 * away chunks
        totals = materialize(totals.join(behind(totals, away), ["conv", "block"], "left").mapInArrow(combine, shape), "chunk-products")
        away *= 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"conv": [], "at": [], "hash": [], "mark": [], "tokens": []}
            for row in batch.to_pylist():
                at, value = row["s"] or 0, _number(row["h"])
                for mark, tokens in zip(row["marks"], row["counts"]):
                    at, value = at + 1, (value * r + element(mark)) % P
                    for name, cell in zip(out, (row["conv"], at, to_bytes(value), mark, tokens)):
                        out[name].append(cell)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    joined = chunk.join(behind(totals, 1), ["conv", "block"], "left")
    wanted = joined.select("conv", "s", "h", F.col("rows.mark").alias("marks"), F.col("rows.tokens").alias("counts"))
    made = wanted.mapInArrow(spread, "conv bigint, at bigint, hash binary, mark string, tokens bigint")
    return materialize(made, "prefixes")


def members(own: DataFrame, rebuilt: DataFrame, r: int) -> DataFrame:
    """Stored (conv, depth, hash, parent, mark, tokens, last) of every rebuilt conversation, from depth 1.

    ``own`` are prefixes, ``rebuilt`` has one row (conv, base, head) per conversation. ``parent`` is the fingerprint one turn
    before, ``last`` whether the conversation ends there.
    """
    sizes = own.groupBy("conv").agg(F.max("at").alias("size"))
    most = rebuilt.agg(F.max("head")).first()[0] or 0
    heads = own.where(F.col("at") <= most).withColumnsRenamed({"conv": "base"})
    known = rebuilt.join(sizes, "conv").join(sizes.select(F.col("conv").alias("base"), F.col("size").alias("b")), "base", "left")
    known = known.withColumn("taken", F.least("head", F.coalesce("b", F.lit(0))))
    known = known.withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("head"), F.lit(0)))
    known = materialize(known.select("conv", "base", "head", "taken", "length"), "rebuilt")
    first = known.join(heads, "base").where(F.col("at") <= F.col("taken"))
    first = first.select("conv", F.col("at").alias("depth"), "hash", "mark", "tokens", "length")

    # what the two products need: the base's head, and the own turns that it replaces
    cut = known.join(heads.select("base", F.col("at").alias("taken"), F.col("hash").alias("head_hash")), ["base", "taken"], "left")
    own_head = heads.select(F.col("base").alias("conv"), F.col("at").alias("head"), F.col("hash").alias("left_out"))
    cut = cut.join(own_head, ["conv", "head"], "left").select("conv", "head", "taken", "length", "head_hash", "left_out")
    later = own.join(cut, "conv").where(F.col("at") > F.col("head"))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, hashes = [], []
            get = lambda name: batch.column(name).to_pylist()  # noqa: E731,B023
            for at, whole, head, taken, front, left in zip(*map(get, ("at", "hash", "head", "taken", "head_hash", "left_out"))):
                own_part = suffix((at, _number(whole)), (head, _number(left)), r)
                n, value = product((taken, _number(front)), own_part, r)
                depth.append(n)
                hashes.append(to_bytes(value))
            columns = [batch.column("conv"), pa.array(depth, pa.int64()), pa.array(hashes, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in ("mark", "tokens", "length"))], names)

    names = ["conv", "depth", "hash", "mark", "tokens", "length"]
    shape = "conv bigint, depth bigint, hash binary, mark string, tokens bigint, length bigint"
    wanted = later.select("conv", "at", "hash", "head", "taken", "head_hash", "left_out", "mark", "tokens", "length")
    both = first.select(names).unionByName(wanted.mapInArrow(compose, shape))

    inverse = pow(r, -1, P)

    def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                to_bytes((_number(h) - element(m)) * inverse % P)
                for h, m in zip(batch.column("hash").to_pylist(), batch.column("mark").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*names, "parent"])

    told = both.mapInArrow(parents, f"{shape}, parent binary")
    return materialize(told.withColumn("last", F.col("depth") == F.col("length")).drop("length"), "members")


def _suffix_sums(df: DataFrame, path: str, depth: str, names: list[str]) -> DataFrame:
    """Sums of ``names`` over the rows of a path from each depth down; a long path is summed in blocks."""
    blocked = df.withColumn("_block", F.floor(F.col(depth) / PATH_BLOCK))
    per = blocked.groupBy(path, "_block").agg(*[F.sum(n).alias(n) for n in names])
    below = Window.partitionBy(path).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(path, "_block", *[F.coalesce(F.sum(n).over(below), F.lit(0)).alias(f"_{n}") for n in names])
    inside = Window.partitionBy(path, "_block").orderBy(F.desc(depth)).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.withColumns({n: F.sum(n).over(inside) for n in names}).join(per, [path, "_block"])
    return summed.withColumns({n: F.col(n) + F.col(f"_{n}") for n in names}).drop("_block", *[f"_{n}" for n in names])


def nodes(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """One row per node: conv (its owner), depth, parent_conv, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows`` are ``members``; ``everyone`` (conv) lists all conversations, those without turns too.
    """
    convs = everyone.agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n")).first()
    spark = rows.sparkSession
    grouped = rows.groupBy("depth", "hash").agg(
        F.min("conv").alias("owner"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("parent").alias("parent"),
        F.first("tokens").alias("tokens"),
    )
    grouped = materialize(grouped, "nodes")
    children = grouped.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("hash")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    children = materialize(children, "children")
    none = F.coalesce("n_children", F.lit(0)).alias("n_children")
    each = grouped.join(children, ["depth", "hash"], "left").select("depth", "owner", "n_convs", "tokens", none)
    top = children.where("depth = 0").agg(F.sum("n_children")).first()[0] or 0
    root = spark.createDataFrame(
        [(0, convs["owner"], convs["n"], 0, top)] if convs["n"] else [],
        "depth bigint, owner bigint, n_convs bigint, tokens bigint, n_children bigint",
    )
    each = each.unionByName(root).select(
        "owner",
        "depth",
        "n_convs",
        "n_children",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved_tokens"),
    )
    each = materialize(each, "node-counts")
    sums = ["n_leaves", "saved_tokens"]
    path = each.groupBy("owner").agg(F.min("depth").alias("from"), *[F.sum(s).alias(s) for s in sums])
    path = materialize(path, "paths")

    # the paths above each path, and the depth where it leaves them
    owned = rows.select("conv", "depth", "hash").join(grouped.select("depth", "hash", "owner"), ["depth", "hash"])
    above = owned.where("owner <> conv").select("conv", "owner", "depth")
    if convs["n"]:
        first = everyone.where(F.col("conv") != convs["owner"])
        above = above.unionByName(first.select("conv", F.lit(convs["owner"]).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth")))
    above = materialize(above.groupBy("conv", "owner").agg(F.max("depth").alias("depth")), "paths-above")
    hanging = above.join(path.withColumnRenamed("owner", "conv"), "conv")
    inflow = hanging.groupBy("owner", "depth").agg(*[F.sum(s).alias(f"in_{s}") for s in sums])
    joined = each.join(inflow, ["owner", "depth"], "left")
    joined = joined.withColumns({s: F.col(s) + F.coalesce(f"in_{s}", F.lit(0)) for s in sums})
    total = _suffix_sums(joined.drop(*[f"in_{s}" for s in sums]), "owner", "depth", sums)
    over = above.groupBy("conv").agg(F.max_by("owner", "depth").alias("over")).withColumnRenamed("conv", "owner")
    placed = path.select("owner", "from").join(over, "owner", "left")
    total = total.join(placed, "owner")
    parent = F.when(F.col("depth") == F.col("from"), F.col("over")).otherwise(F.col("owner"))

    name = lambda depth, conv: F.concat_ws(":", depth.cast("string"), conv.cast("string"))
    ends = rows.where("last").select("conv", "depth", "hash").join(grouped.select("depth", "hash", "owner"), ["depth", "hash"])
    ends = ends.select("conv", name(F.col("depth"), F.col("owner")).alias("node"))
    if convs["n"]:
        silent = everyone.join(rows.select("conv").distinct(), "conv", "left_anti")
        ends = ends.unionByName(silent.select("conv", name(F.lit(0), F.lit(convs["owner"])).alias("node")))
    pieces = ends.groupBy("node", F.floor(F.col("conv") / PIECE).alias("part")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    pieces = pieces.select("node", "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("piece"), F.lit("").alias("none"))
    told = streamed(materialize(pieces, "ends"), "node", "part", "piece", ",", "none")
    out = total.withColumn("node", name(F.col("depth"), F.col("owner"))).join(
        told.select(F.col("key").alias("node"), "digest"), "node", "left"
    )
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("owner").alias("conv"),
        "depth",
        parent.alias("parent_conv"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("digest", F.lit(empty)).alias("ends_sha256"),
    )


def _sound(rows: DataFrame) -> bool:
    """Whether the members of every node agree in their last turn and in their parent."""
    seen = rows.groupBy("depth", "hash").agg(
        *[(F.min(c) == F.max(c)).alias(c) for c in ("mark", "parent")]
    )
    return seen.where("NOT (mark AND parent)").isEmpty()


def trie(
    df: DataFrame,
    base: Column,
    head: Column,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (see ``nodes``), without any for an empty table.

    ``base`` and ``head`` are columns over ``conv``: the first ``head`` turns of conversation ``base`` (all if it has fewer,
    none if there is none) stand in front of the own turns behind the first ``head``. Rows with a null conversation are
    left out; repeated rows are turns of their own.
    """
    ids = df.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias(conv)).distinct()
    rebuilt = ids.select(F.col(conv).alias("conv"), base.cast("long").alias("base"), head.cast("long").alias("head"))
    rebuilt = materialize(rebuilt, "plans")
    for seed in range(ATTEMPTS):
        placed, right = turns(df, conv, turn, role, text, seed)
        if not right:
            continue
        r = base_of(seed)
        rows = members(prefixes(placed, r), rebuilt, r)
        if _sound(rows):
            return nodes(rows, rebuilt.select("conv"))
    raise RuntimeError("fingerprints of different turns are equal with every base")
