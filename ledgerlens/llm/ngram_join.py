"""Jaccard join of word n-gram sets: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

Sizes are cut into bands so wide that a linked pair lies in one band or in two neighbouring ones. For each band (of the
smaller set) the n-grams are dealt to parts by hash, more parts than a linked pair may have differing n-grams: at least
``SPARE`` + 1 parts of the two sets are then equal. A tile is (band, part, content of the part), so linked sets share a
tile, and unrelated sets hardly ever do, even where they share a passage.

1. Rows with the same set are one class. Tiles of one class only are left.
2. In each tile the class that meets the most others leads; it meets the tile's other classes. A pair goes on if bit
   counts allow the overlap: the signatures are parity bitmaps, and every differing bit is a differing n-gram. Then the
   sorted sets are intersected.
3. Tiles that still hold several components are dealt out in blocks whose rows bound their memory. A task compares the
   signatures of two blocks. First it gives on fewer pairs than rows, as many as may join components, so a large group of
   near copies is never written out pair by pair; what is apart after these are decided gives all pairs that bit counts
   allow. Again the sorted sets decide.
4. Components of the links are the result. No link between different sets is lost; only the equality of n-grams, parts
   and whole sets rests on 64-bit hashes (128 bits and the size for whole sets).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .marks import text_hash
from .words import NOT_SPACE, grams, mix, slices, word_hashes

NGRAM = 3
THRESHOLD = (90, 100)
SPARE = 2  # equal parts of a linked pair beyond the first
LONGEST = 1 << 40
BITS_MIN, BITS_MAX = 64, 1 << 16  # bits of a signature, about four for each n-gram
PARTNERS = 4_000  # partners that one copy of a leading set meets
BLOCK_GRAMS, BLOCK_ROWS = 1_000_000, 1_024  # n-grams and rows of a block at most
BROADCAST_ROWS = 200_000  # classes that may be looked up by a broadcast table; more are shuffled

_PART, _BIT, _TILE = (np.uint64(s) for s in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))


def gram_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its different n-grams; a shorter text is one; no word, none."""
    values, counts = word_hashes(texts, NOT_SPACE)
    hashed, rows, _ = grams(values, counts, NGRAM)
    first = np.searchsorted(rows, np.arange(len(counts) + 1))
    word = np.cumsum(counts) - counts
    for i, n in enumerate(counts.tolist()):
        if n >= NGRAM:
            yield np.unique(hashed[first[i] : first[i + 1]])
        elif n:
            yield grams(values[word[i] : word[i] + n], np.array([n]), n)[0]
        else:
            yield np.zeros(0, dtype=np.uint64)


class Bands:
    """Size bands for a threshold (a, b), meaning a / b: ``low`` of each band, and the parts of its tiles."""

    def __init__(self, threshold: tuple[int, int]):
        a, b = threshold
        low, parts = [1], []
        while low[-1] < LONGEST:
            high = low[-1] * b // a
            apart = (high + high * b // a) * (b - a) // (a + b)  # differing n-grams of a linked pair at most
            parts.append(apart + 1 + SPARE if apart else 0)  # without any, only equal sets are linked
            low.append(high + 1)
        self.low, self.parts = np.array(low), np.array(parts + [0])

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1


def tiles(sets: list[np.ndarray], bands: Bands) -> list[np.ndarray]:
    """The keys of the tiles that each set lies in: those of its own band and of the one below."""
    sizes = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    found: list[list[np.ndarray]] = [[] for _ in sets]
    hashed, value = mix(flat ^ _PART), mix(flat * _TILE)
    for below in (0, 1):
        band = bands.of(sizes) - below
        parts = np.where(band >= 0, bands.parts[np.maximum(band, 0)], 0)
        begin = np.cumsum(parts) - parts
        used = np.flatnonzero(parts[row] > 0)
        if not len(used):
            continue
        cell = begin[row[used]] + (hashed[used] % parts[row[used]].astype(np.uint64)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        first = np.flatnonzero(np.diff(cell[order], prepend=-1))
        total = np.zeros(parts.sum(), dtype=np.uint64)
        filled = np.zeros(parts.sum(), dtype=bool)
        total[cell[order][first]] = np.add.reduceat(value[used][order], first)
        filled[cell[order][first]] = True
        owner = np.repeat(np.arange(len(sets)), parts)
        place = np.arange(len(owner)) - begin[owner]
        name = (band[owner].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64)
        key = mix(mix(name) + total)
        # a set with many empty parts may agree with another one in these alone
        empty = np.bincount(owner[~filled], minlength=len(sets))
        keep = np.flatnonzero(filled | (empty[owner] > SPARE))
        ends = np.searchsorted(owner[keep], np.arange(len(sets) + 1))
        for i in range(len(sets)):
            found[i].append(key[keep[ends[i] : ends[i + 1]]])
    return [np.concatenate(f) if f else np.zeros(0, dtype=np.uint64) for f in found]


def bitmap(grams_: np.ndarray) -> bytes:
    """The parity of the n-grams that fall on each bit."""
    bits = BITS_MIN
    while bits < min(4 * len(grams_), BITS_MAX):
        bits *= 2
    at = (mix(grams_ * _BIT) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).astype(np.uint8).tobytes()


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all folded to the shortest."""
    least = min(map(len, maps))
    out = np.empty((len(maps), least // 8), dtype=np.uint64)
    for i, m in enumerate(maps):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(m, dtype=np.uint64).reshape(-1, least // 8), axis=0)
    return out


def may_link(apart: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """Whether sets of n and m n-grams whose bitmaps differ in ``apart`` bits can reach the threshold."""
    both = np.minimum((n + m - apart) // 2, np.minimum(n, m))
    return threshold[1] * both >= threshold[0] * (n + m - both)


def linked(a: np.ndarray, b: np.ndarray, threshold: tuple[int, int]) -> bool:
    """Whether two sorted sets reach the threshold."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return threshold[1] * both >= threshold[0] * (len(a) + len(b) - both)


def signatures(df: DataFrame, key: str, text: str, threshold: tuple[int, int]) -> DataFrame:
    """row, key, text_hash, n, print1, print2, tiles, bitmap: one stored row per input row."""
    bands = Bands(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1), 1 << 20):
                sets = list(gram_sets(texts))
                with np.errstate(over="ignore"):
                    one = [int(s.view(np.int64).sum()) for s in sets]
                    two = [int(mix(s).view(np.int64).sum()) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sets)),
                        batch.column(2).slice(at, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(one, pa.int64()),
                        pa.array(two, pa.int64()),
                        pa.array([t.view(np.int64) for t in tiles(sets, bands)], pa.list_(pa.int64())),
                        pa.array([bitmap(s) for s in sets], pa.binary()),
                    ],
                    ["key", "text_hash", "n", "print1", "print2", "tiles", "bitmap"],
                )

    plain = F.col(text).cast("string")
    narrow = df.select(F.col(key).alias("key"), plain.alias("text"), text_hash(plain).alias("text_hash"))
    kind = narrow.schema["key"].dataType.simpleString()
    shape = f"key {kind}, text_hash bigint, n bigint, print1 bigint, print2 bigint, tiles array<bigint>, bitmap binary"
    return materialize(narrow.mapInArrow(run, shape).select(F.monotonically_increasing_id().alias("row"), "*"), "signatures")


def _sets(df: DataFrame, key: str, text: str, lead: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored (class, n, bitmap, grams) of the ``wanted`` classes, from the whole texts of their first rows."""
    listed = lead.join(wanted, "class", "left_semi").select("class", "key", "text_hash", "n", "print1", "bitmap")
    listed = materialize(listed.withColumnsRenamed({"key": "k", "text_hash": "h"}), "wanted-classes")
    small = F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed
    plain = F.col(text).cast("string")
    texts = df.select(F.col(key).alias("key"), plain.alias("text"), text_hash(plain).alias("hash"))
    found = texts.join(small, F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(0), 1 << 20):
                sets = [s.view(np.int64) for s in gram_sets(part)]
                told = batch.slice(at, len(sets))
                with np.errstate(over="ignore"):  # a key may stand on several rows: only the class's own text counts
                    right = [
                        i for i, (s, p) in enumerate(zip(sets, told.column("print1").to_pylist())) if int(s.sum()) == p
                    ]
                kept = told.take(pa.array(right, pa.int64()))
                grams_ = pa.array([np.sort(sets[i].view(np.uint64)).view(np.int64) for i in right], pa.list_(pa.int64()))
                columns = [*(kept.column(c) for c in ("class", "n", "bitmap")), grams_]
                yield pa.RecordBatch.from_arrays(columns, ["class", "n", "bitmap", "grams"])

    shape = "class bigint, n bigint, bitmap binary, grams array<bigint>"
    made = found.select("text", "class", "n", "bitmap", "print1").mapInArrow(run, shape)
    return materialize(made.dropDuplicates(["class"]), "gram-sets")


def _leads(rows: DataFrame) -> DataFrame:
    """Stored (tile, lead, parts): the class of a tile that meets the most others in all its tiles.

    ``parts`` is how many copies of its set deal with its partners.
    """
    sizes = materialize(rows.groupBy("tile").agg(F.count(F.lit(1)).alias("size")), "tile-sizes")
    sized = rows.join(sizes, "tile")
    degree = materialize(sized.groupBy("class").agg(F.sum("size").alias("degree")), "degrees")
    order = F.struct("degree", "class")
    leads = rows.join(degree, "class").groupBy("tile").agg(F.max(order).alias("lead"))
    parts = F.ceil(F.col("lead.degree") / PARTNERS).cast("long")
    return materialize(leads.select("tile", F.col("lead.class").alias("lead"), parts.alias("parts")), "leads")


def _lead_pairs(rows: DataFrame, leads: DataFrame) -> DataFrame:
    """Stored (a, part, parts, b): each tile's leading class with the others; ``part`` deals its partners out."""
    joined = rows.join(leads, "tile").where("class <> lead")
    part = F.pmod(F.xxhash64("class"), F.col("parts"))
    pairs = joined.select(F.col("lead").alias("a"), part.alias("part"), "parts", F.col("class").alias("b"))
    return materialize(pairs.distinct(), "lead-pairs")


def _both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs with ``columns`` of both classes; a leader's row is copied for each part of its partners."""
    side = lambda name: table.select(F.col("class").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
    parts = materialize(pairs.select("a", "part").distinct(), "parts")
    copies = side("a").join(F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts, "a")
    return pairs.join(side("b"), "b").join(copies, ["a", "part"])


def _plausible(pairs: DataFrame, lead: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose overlap bit counts do not rule out; stored."""
    a, b = threshold
    names = ["a", "part", "parts", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b")))
            apart = np.array([int(np.bitwise_count(x ^ y).sum()) for x, y in map(folded, maps)], dtype=np.int64)
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            yield batch.select(names).filter(pa.array(may_link(apart, n, m, threshold)))

    both = _both(pairs, lead, ["n", "bitmap"]).where(f"{b} * least(n_a, n_b) >= {a} * greatest(n_a, n_b)")
    kept = both.select(*names, "n_a", "n_b", "bitmap_a", "bitmap_b")
    return materialize(kept.mapInArrow(run, "a bigint, part bigint, parts bigint, b bigint"), "plausible-pairs")


def _decided(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The linked pairs (a, b), by their full sets; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("grams_a"), batch.column("grams_b")
            get = lambda column, i: column[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            keep = [linked(get(a, i), get(b, i), threshold) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = _both(pairs, sets, ["grams"]).select("a", "b", "grams_a", "grams_b")
    return materialize(both.mapInArrow(run, "a bigint, b bigint"), "linked-pairs")


def plausible_links(left: list[dict], right: list[dict], every: bool, threshold: tuple[int, int] = THRESHOLD) -> list[tuple[int, int]]:
    """Pairs of rows of ``left`` and ``right`` in different components whose bit counts allow a link.

    Rows have class, component, n and bitmap. Unless ``every`` pair is wanted, those that join no further components are
    left out, so that there are fewer pairs than rows.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    maps = folded([r["bitmap"] for r in left + right])
    others, sizes = maps[len(left) :], np.array([r["n"] for r in right])
    component = np.array([r["component"] for r in right])
    out = []
    for i, row in enumerate(left):
        apart = np.bitwise_count(others ^ maps[i]).sum(axis=1).astype(np.int64)
        may = may_link(apart, sizes, np.full(len(right), row["n"]), threshold) & (component != row["component"])
        for j in np.flatnonzero(may).tolist():
            x, y = find(row["component"]), find(right[j]["component"])
            if every or x != y:
                parent[max(x, y)] = min(x, y)
                out.append((row["class"], right[j]["class"]))
    return out


def _open(rows: DataFrame, leads: DataFrame, found: DataFrame) -> DataFrame:
    """Stored (tile, class, component, main) of tiles whose classes, but for the leader, are in several components.

    ``main`` is the tile's most frequent component. Of tiles with the same classes one is enough.
    """
    told = rows.join(leads.select("tile", "lead"), "tile").where("class <> lead").drop("lead")
    told = told.join(found.withColumnRenamed("node", "class"), "class", "left")
    told = told.withColumn("component", F.coalesce("component", "class"))
    by = told.groupBy("tile", "component").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(F.xxhash64("class").cast("decimal(20,0)")).alias("one"),
        F.sum(F.xxhash64("class", F.lit(1)).cast("decimal(20,0)")).alias("two"),
    )
    each = by.groupBy("tile").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"),
        F.count(F.lit(1)).alias("components"),
        *[F.sum(c).alias(c) for c in ("size", "one", "two")],
    )
    several = each.where("components > 1").groupBy("size", "one", "two").agg(F.min(F.struct("tile", "main")).alias("t"))
    return materialize(told.join(materialize(several.select("t.tile", "t.main"), "open-tiles"), "tile"), "open-rows")


def _rest(rows: DataFrame, lead: DataFrame, every: bool, threshold: tuple[int, int]) -> DataFrame:
    """Stored pairs (a, part, parts, b) that may link components which still share tiles (see ``plausible_links``).

    A tile's rows outside its main component meet all of its rows, block by block; only signatures are carried there.
    """
    outside = F.col("component") != F.col("main")
    signed = rows.join(lead.select("class", "n"), "class")
    per = signed.groupBy("tile").agg(
        F.count(F.lit(1)).alias("size"), F.count_if(outside).alias("outer"), F.max("n").alias("most")
    )
    fit = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_GRAMS) / F.col("most"))))
    per = per.select("tile", *[F.ceil(F.col(c) / fit).cast("int").alias(c) for c in ("size", "outer")])
    told = rows.join(materialize(per, "tile-blocks"), "tile")
    mine = lambda blocks: F.pmod(F.xxhash64("class"), F.col(blocks)).cast("int")
    all_of = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    columns = ["tile", "class", "component"]
    left = told.where(outside).select(*columns, F.lit(True).alias("outside"), mine("outer").alias("i"), all_of("size").alias("j"))
    right = told.select(*columns, F.lit(False).alias("outside"), mine("size").alias("j"), all_of("outer").alias("i"))
    dealt = left.unionByName(right).join(lead.select("class", "n", "bitmap"), "class")

    def run(table: pa.Table) -> pa.Table:
        sides: dict[bool, list[dict]] = {True: [], False: []}
        for row in table.select(["class", "component", "n", "bitmap", "outside"]).to_pylist():
            sides[row["outside"]].append(row)
        found = plausible_links(sides[True], sides[False], every, threshold) if all(sides.values()) else []
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    pairs = dealt.groupBy("tile", "i", "j").applyInArrow(run, "a bigint, b bigint")
    pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "rest-pairs")
    count = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("long").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    parted = pairs.join(materialize(count, "many-partners"), "a", "left")
    return materialize(parted.select("a", F.pmod(F.xxhash64("b"), parts).alias("part"), parts.alias("parts"), "b"), "parted-pairs")


def linked_classes(df: DataFrame, key: str, text: str, lead: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(node, component) of the classes that are linked with others."""
    none = df.sparkSession.createDataFrame([], "node bigint, component bigint")
    placed = lead.select("class", F.explode("tiles").alias("tile"))
    shared = placed.groupBy("tile").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    rows = materialize(placed.join(shared.select("tile"), "tile"), "tile-rows")
    if rows.isEmpty():
        return none
    leads = _leads(rows)

    def decided(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        return _decided(pairs, _sets(df, key, text, lead, wanted), threshold)

    links = decided(_plausible(_lead_pairs(rows, leads), lead, threshold))
    found = none if links.isEmpty() else materialize(components(links), "components")
    # first pairs that may join components, as few as that takes; then all that may still do so
    for every in (False, True):
        opened = _open(rows, leads, found)
        if opened.isEmpty():
            break
        pairs = _rest(opened, lead, every, threshold)
        more = none if pairs.isEmpty() else decided(pairs)
        if more.isEmpty():
            if every or pairs.isEmpty():
                break
            continue
        links = links.unionByName(more)
        found = materialize(components(links), "components")
    return found


def join_classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """One row per input row: row, key, n_shingles, component_key.

    Rows are linked if their n-gram sets have a similarity of ``threshold`` or more; ``component_key`` is the least key
    reachable. A null key is larger than any other. Rows without words (null, empty or blank texts) are linked with nothing;
    an empty table gives no row.
    """
    rows = signatures(df, key, text, threshold)
    same = ["n", "print1", "print2"]
    filled = rows.where("n > 0")
    least = materialize(filled.groupBy(same).agg(F.min("row").alias("class")), "classes")
    of = filled.select("row", "key", *same).join(least, same).select("row", "key", "class")
    first = least.select(F.col("class").alias("row"))
    lead = materialize(rows.join(first, "row").withColumnRenamed("row", "class"), "class-signatures")
    found = linked_classes(df, key, text, lead, threshold)
    joined = of.join(found.withColumnRenamed("node", "class"), "class", "left")
    joined = joined.select("row", "key", F.coalesce("component", "class").alias("component"))
    order = F.struct(F.col("key").isNull().alias("last"), F.col("key"))
    lowest = materialize(joined.groupBy("component").agg(F.min(order).alias("least")), "least-keys")
    told = joined.join(lowest, "component").select("row", F.col("least.key").alias("component_key"), F.lit(True).alias("told"))
    out = rows.select("row", "key", F.col("n").alias("n_shingles")).join(told, "row", "left")
    component = F.when(F.col("told"), F.col("component_key")).otherwise(F.col("key"))
    return out.select("row", "key", "n_shingles", component.alias("component_key"))
