"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. All different blocks are sorted and get integer names; then the
different pairs of neighbouring names are sorted and named, and so on, until one name is left for each text. Two texts
of one length have the same last name exactly if they are equal: names are given to contents, never to hashes.

Blocks are sorted by (hash, content). Only the hash travels with the rows: a name is looked up by the hash, and by
the content too for the rare hashes that two different blocks share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .marks import keep_marked, text_hash

BLOCK = 16384
SHARED_LIMIT = 100_000  # so many shared hashes may be listed in a plan; above, every block carries its content
NO_BLOCK, NO_PARTNER = -(2**62), -(2**62) + 1

Hash = Callable[[Column], Column]


def _blocks(text: Column, size: int) -> Column:
    """The bytes of a text in blocks; an empty text has none."""
    whole = text.cast("binary")
    count = F.ceil(F.octet_length(whole) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(whole, i * size + 1, F.lit(size)))
    return F.when(count > 0, cut).otherwise(F.array().cast("array<binary>"))


def _named(different: DataFrame, by: list[str], keep: list[str], label: str) -> DataFrame:
    """Sort different rows and number them; stored, so that the numbers stay."""
    ordered = different.sortWithinPartitions(*by)
    return materialize(ordered.select(*keep, F.monotonically_increasing_id().alias("name")), label)


def block_names(texts: DataFrame, size: int, hashed: Hash) -> tuple[DataFrame, Callable[[Column], Column]]:
    """(hash, content, name) of every different block, and which hashes need the content to tell the block.

    ``content`` is null where the hash alone is enough.
    """
    block = texts.select(F.explode(_blocks(F.col("text"), size)).alias("content"))
    block = block.select(hashed(F.col("content")).alias("hash"), "content").distinct()
    names = _named(block, ["hash", "content"], ["hash"], "block-names")
    several = names.groupBy("hash").count().where("count > 1").select("hash")
    shared = [row[0] for row in several.limit(SHARED_LIMIT + 1).collect()]
    plain = names.withColumn("content", F.lit(None).cast("binary"))
    if not shared:
        return plain, lambda _: F.lit(False)
    needed = (lambda h: h.isin(shared)) if len(shared) <= SHARED_LIMIT else lambda _: F.lit(True)
    told = _named(block.where(needed(F.col("hash"))), ["hash", "content"], ["hash", "content"], "shared-names")
    told = told.withColumn("name", -1 - F.col("name"))
    return plain.where(~needed(F.col("hash"))).unionByName(told), needed


def _next_level(level: DataFrame) -> DataFrame:
    """Name the pairs of neighbouring names: (row, pos, left, name) with half as many names for each row."""
    half = level.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
        F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("second"),
        F.ceil(F.max("left") / 2).cast("int").alias("left"),
    )
    half = materialize(half, "pairs")
    pair = ["first", "second"]
    names = _named(half.select(pair).distinct(), pair, pair, "pair-names")
    return materialize(half.join(names, pair).select("row", "pos", "left", "name"), "names")


def identities(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK, hashed: Hash = F.xxhash64
) -> DataFrame:
    """(row, key, text_sha256, text_hash, n_bytes, name), one row per input row: texts are equal if (n_bytes, name) are.

    ``row`` numbers the input rows and ``key`` holds the key column. Null texts count as empty; an empty table gives an
    empty result. ``hashed`` only spreads the work: whatever collides, the result is the same.
    """
    texts = df.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    names, needed = block_names(texts, size, hashed)
    entry = lambda b: F.struct(hashed(b).alias("hash"), F.when(needed(hashed(b)), b).alias("content"))
    rows = materialize(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "key",
            F.sha2("text", 256).alias("text_sha256"),
            text_hash(F.col("text")).alias("text_hash"),
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.transform(_blocks(F.col("text"), size), entry).alias("blocks"),
        ),
        "block-rows",
    )
    found = rows.select("row", F.size("blocks").alias("left"), F.posexplode("blocks").alias("pos", "block"))
    found = found.select("row", "left", "pos", F.col("block.hash").alias("hash"), F.col("block.content").alias("content"))
    same = (found["hash"] == names["hash"]) & found["content"].eqNullSafe(names["content"])
    level = materialize(found.join(names, same).select("row", "pos", "left", "name"), "names")
    last = rows.where(F.size("blocks") == 0).select("row", F.lit(NO_BLOCK).cast("long").alias("name"))
    most = rows.agg(F.max(F.size("blocks"))).first()[0] or 0
    while most > 1:
        last = last.unionByName(level.where("left = 1").select("row", "name"))
        level = _next_level(level.where("left > 1"))
        most = (most + 1) // 2
    last = last.unionByName(level.select("row", "name"))
    return rows.drop("blocks").join(last, "row")


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per input row: row, key, keep_key, group_size, kept, text_sha256, text_hash.

    Of equal texts the row with the largest key stays; of repeated rows with that key, one (the last read). A null key
    is smaller than any other.
    """
    told = materialize(identities(df, key, text, **options), "identities")
    identity = ["n_bytes", "name"]
    best = told.groupBy(identity).agg(
        F.max(F.struct("key", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    best = materialize(best, "groups")
    return told.join(best, identity).select(
        "row",
        "key",
        F.col("best.key").alias("keep_key"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "text_hash",
    )


def drop_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay, all columns as they are.

    Rows are told apart by key and text; where both are repeated, one of the repeated rows stays.
    """
    marks = materialize(groups(df, key, text, **options).select("key", "text_hash", "kept"), "marks")
    return keep_marked(df, marks, key, text)
