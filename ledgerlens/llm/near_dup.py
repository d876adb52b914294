"""Near-duplicate classes by SetSketch registers.

A text's set holds its different five-word shingles. Register i of its sketch is the truncated logarithm, with base
``BASE``, of the least of one exponential value per shingle: exponentially spaced truncated minima. Registers of a
union are the larger ones of its parts, and the share of equal registers of two sets follows their similarity.

1. Rows with the same set are one class; only its first row goes on.
2. Bands of registers are bucket keys. A first pass over a few bands links each class to the leading class of its
   buckets; a second pass does so for all buckets that still hold several components. Of these pairs, those whose
   similarity cannot reach the threshold by the joint likelihood of both sketches are left.
3. The classes of buckets that are open even then are paired by an exact prefix filter. All pairs are decided on the
   full sets.
4. Components of the confirmed links are the result.

With 40 bands of 6 registers a pair at similarity 0.8 shares no bucket with probability 5e-6, at 0.85 with 6e-9, and
the likelihood check loses one with probability 3e-7 (five standard errors).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import batch_rows, materialize
from .components import components
from .marks import few_tasks, keep_marked, text_hash
from .words import NOT_SPACE, grams, mix, slices, word_hashes

SHINGLE = 5
BANDS, ROWS = 40, 6
FIRST_BANDS = 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2  # sketch parameters b, a and q
THRESHOLD = (85, 100)  # least similarity of linked rows, where a caller names no other
ERRORS = 5  # standard errors that the likelihood estimate may be off
TASK_ROWS, TASK_SETS, TASK_PAIRS = 50_000, 4_000, 4_000  # rows of small steps that a task takes
BATCH_ROWS = 1_000  # texts or sketches of pairs in an Arrow batch
PARTNERS = 2_000  # partners that one copy of a class meets
BROADCAST_ROWS = 200_000  # classes whose rows may be looked up by a broadcast table; more are shuffled

_rng = np.random.default_rng(77)
_FACTORS = _rng.integers(1, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its different shingles; a shorter text is one shingle; no word, no shingle."""
    values, counts = word_hashes(texts, NOT_SPACE)
    hashed, rows, _ = grams(values, counts, SHINGLE)
    first = np.searchsorted(rows, np.arange(len(counts) + 1))
    word = np.cumsum(counts) - counts
    for i, n in enumerate(counts.tolist()):
        if n >= SHINGLE:
            yield np.unique(hashed[first[i] : first[i + 1]])
        elif n:
            yield grams(values[word[i] : word[i] + n], np.array([n]), n)[0]
        else:
            yield np.zeros(0, dtype=np.uint64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches of non-empty sets, one row each."""
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), REGISTERS), dtype=np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(flat * _FACTORS[i] + _SHIFTS[i], first)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    value = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def bands(sketch: np.ndarray) -> np.ndarray:
    """A key per band of each sketch."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def likely_similarity(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The similarity of greatest likelihood, given both sketches and both set sizes, for rows of pairs.

    The log-likelihood is concave, so its greatest value is found by halving on the derivative.
    """
    m = ra.shape[1]
    above, below = (ra > rb).sum(1), (ra < rb).sum(1)
    equal = m - above - below
    u, v = na / (na + nb), nb / (na + nb)
    scale = (BASE - 1) / BASE
    log_base = np.log(BASE)

    def derivative(j: np.ndarray) -> np.ndarray:
        xa, xb = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        pa_, pb_ = -np.log1p(-xa * scale) / log_base, -np.log1p(-xb * scale) / log_base
        da, db = -v * scale / (1 - xa * scale) / log_base, -u * scale / (1 - xb * scale) / log_base
        same = np.maximum(1 - pa_ - pb_, 1e-12)
        return above * da / np.maximum(pa_, 1e-12) + below * db / np.maximum(pb_, 1e-12) - equal * (da + db) / same

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        middle = (low + high) / 2
        up = derivative(middle) > 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """row, key, text_hash, n_shingles, print1, print2, bands, registers: one stored row per input row.

    The prints are two independent sums over the full set, so that equal sets can be grouped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1), 1 << 20):
                sets = list(shingle_sets(texts))
                filled = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                sketch: list = [None] * len(sets)
                if filled:
                    found = registers([sets[i] for i in filled])
                    for i, k, r in zip(filled, bands(found).view(np.int64), found):
                        keys[i], sketch[i] = k, r.astype("<u2").tobytes()
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
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(sketch, pa.binary()),
                    ],
                    ["key", "text_hash", "n_shingles", "print1", "print2", "bands", "registers"],
                )

    plain = F.col(text).cast("string")
    narrow = df.select(F.col(key).alias("key"), plain.alias("text"), text_hash(plain).alias("text_hash"))
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, text_hash bigint, n_shingles bigint, print1 bigint, print2 bigint, bands array<bigint>, registers binary"
    made = narrow.mapInArrow(run, schema)
    return materialize(made.select(F.monotonically_increasing_id().alias("row"), "*"), "sketches")


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the same full set are one class, named by its first row: (of every row, with sketch of the first)."""
    same = ["n_shingles", "print1", "print2"]
    filled = rows.where("n_shingles > 0")
    least = materialize(filled.groupBy(same).agg(F.min("row").alias("class")), "classes")
    members = filled.select("row", "key", *same).join(least, same).select("row", "key", "class")
    # the first rows carry the sketch: no copy of a text goes further
    lead = least.select(F.col("class").alias("row"))
    return members, materialize(rows.join(lead, "row").withColumnRenamed("row", "class"), "class-sketches")


def _parted(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) with ``part``, which deals the partners of a class out over several copies of it."""
    count = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1)))
    return pairs.join(materialize(count, "many-partners"), "a", "left").select("a", part.alias("part"), "b")


def _both(pairs: DataFrame, table: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """The pairs with ``columns`` of both classes. The row of ``a`` is copied for each part of its partners, so a class
    that leads very many others is met by a bounded number of them in one place."""
    side = lambda name: table.select(F.col("class").alias(name), *[F.col(c).alias(f"{new}{name}") for c, new in columns])
    parts = materialize(pairs.select("a", "part").distinct(), "parts")
    copies = side("a").join(F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts, "a")
    return pairs.join(side("b"), "b").join(copies, ["a", "part"])


def _plausible(pairs: DataFrame, sketch: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, part, b) whose similarity may reach the threshold by the joint likelihood of their sketches."""
    wanted = threshold[0] / threshold[1]
    slack = ERRORS * (wanted * (1 - wanted) / REGISTERS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            view = lambda name: np.stack([np.frombuffer(x, "<u2") for x in batch.column(name).to_pylist()])
            na, nb = (batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
            likely = likely_similarity(view("ra"), view("rb"), na, nb)
            keep = pa.array(likely >= wanted - slack)
            yield batch.select(["a", "part", "b"]).filter(keep)

    joined = _both(pairs, sketch, [("registers", "r"), ("n_shingles", "n")])
    # set sizes alone bound the similarity
    sized = joined.where(f"{threshold[1]} * least(na, nb) >= {threshold[0]} * greatest(na, nb)")
    return sized.select("a", "part", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a bigint, part bigint, b bigint")


def _sets(df: DataFrame, key: str, text: str, sketch: DataFrame, wanted: DataFrame, count: int) -> DataFrame:
    """(class, shingles) of ``wanted`` classes (at most ``count``), from the whole texts; stored."""
    listed = sketch.join(wanted, "class", "left_semi")
    listed = listed.select("class", F.col("key").alias("wanted"), "n_shingles", "print1")
    if count <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    texts = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    found = texts.join(listed, texts["key"].eqNullSafe(listed["wanted"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(0), 1 << 20):
                sets = [s.view(np.int64) for s in shingle_sets(part)]
                told = batch.slice(at, len(sets)).select(["class", "n_shingles", "print1"]).to_pylist()
                with np.errstate(over="ignore"):
                    # a key may stand on several rows: only the class's own text counts
                    right = [
                        i for i, (s, t) in enumerate(zip(sets, told))
                        if len(s) == t["n_shingles"] and int(s.sum()) == t["print1"]
                    ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([told[i]["class"] for i in right], pa.int64()),
                        pa.array([sets[i] for i in right], pa.list_(pa.int64())),
                    ],
                    ["class", "shingles"],
                )

    made = found.select("text", "class", "n_shingles", "print1").mapInArrow(run, "class bigint, shingles array<bigint>")
    return materialize(few_tasks(made.dropDuplicates(["class"]), count, TASK_SETS), "shingle-sets")


def _decided(pairs: DataFrame, sets: DataFrame, count: int, threshold: tuple[int, int]) -> DataFrame:
    """Of ``count`` pairs (a, part, b) those that are linked, by their full sets; stored."""
    joined = _both(pairs, sets, [("shingles", "s")])
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    counted = joined.select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).cast("long").alias("sizes"))
    counted = counted.where(_linked(F.col("both"), F.col("sizes") - F.col("both"), threshold))
    return materialize(few_tasks(counted.select("a", "b"), count, TASK_PAIRS), "linked-pairs")


def _linked(both: Column, either: Column, threshold: tuple[int, int]) -> Column:
    return threshold[1] * both >= threshold[0] * either


def _shared_rows(sketch: DataFrame) -> DataFrame:
    """(band, bucket, class) of the buckets that hold several classes; stored. Only these can ever link anything, and a
    class stands in a bucket once, so that counting tells them: the keys alone are shuffled, and once for all steps."""
    placed = sketch.select("class", F.posexplode("bands").alias("band", "bucket"))
    several = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    return materialize(placed.join(materialize(several, "shared-buckets"), "bucket"), "shared-rows")


def _open_rows(placed: DataFrame) -> DataFrame:
    """The rows (bucket, class, component, size) of buckets that hold several components; stored."""
    spread = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")
    )
    several = materialize(spread.where("low <> high").select("bucket", "size"), "open-buckets")
    return materialize(placed.join(several, "bucket"), "open-rows")


def _lead_pairs(rows: DataFrame, size: int) -> DataFrame:
    """(a, b): the leading class of each open bucket with the bucket's classes of other components.

    The leading class is the one that meets the most others in all its buckets: in a group of near copies, the text
    that they were made from.
    """
    degree = rows.groupBy("class").agg(F.sum("size").alias("degree"))
    degree = materialize(few_tasks(degree, size, TASK_ROWS), "degrees")
    order = F.struct("degree", (-F.col("class")).alias("first"), "component")
    leads = rows.join(degree, "class").groupBy("bucket").agg(F.max(order).alias("lead"))
    joined = rows.join(materialize(few_tasks(leads, size, TASK_ROWS), "leads"), "bucket").where("component <> lead.component")
    return joined.select((-F.col("lead.first")).alias("a"), F.col("class").alias("b")).distinct()


def _prefix_pairs(rows: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(a, b): classes of different components that may still be linked, by an exact prefix filter on their sets.

    Sets are put in one order, rarest shingle first. To reach the threshold, sets of n and m shingles must share
    ``needed`` of them, so they share one among the first n - needed + 1 and m - needed + 1. Texts with many shingles of
    their own thus meet nothing. For a shingle that many classes have, only classes outside its most frequent component
    look for partners.
    """
    whole = sets.select("class", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    size = sets.agg(F.sum(F.size("shingles"))).first()[0]
    often = whole.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    often = materialize(few_tasks(often, size, TASK_ROWS), "shingle-counts")
    rank = F.row_number().over(Window.partitionBy("class").orderBy("often", "shingle"))
    ranked = whole.join(often, "shingle").withColumn("at", rank)
    # the longest prefix, for a partner of the least size that may be linked
    least = F.ceil(F.col("n") * threshold[0] / threshold[1])
    first = ranked.where((F.col("at") <= F.col("n") - least + 1) & (F.col("often") > 1))
    component = rows.select("class", "component").distinct()
    first = first.join(component, "class").select("shingle", "class", "component", "n", "at")
    first = materialize(few_tasks(first, size, TASK_ROWS), "prefixes")
    by = first.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("count"))
    main = by.groupBy("shingle").agg(F.max(F.struct("count", "component")).alias("main"))
    main = materialize(few_tasks(main, size, TASK_ROWS), "main-components")
    seeking = first.join(main, "shingle").where("component <> main.component").drop("main")
    other = first.select("shingle", *[F.col(c).alias(f"o_{c}") for c in ("class", "component", "n", "at")])
    needed = f"ceil((n + o_n) * {threshold[0]} / {threshold[0] + threshold[1]})"
    joined = seeking.join(other, "shingle").where(f"component <> o_component AND at <= n - {needed} + 1 AND o_at <= o_n - {needed} + 1")
    return joined.select(F.least("class", "o_class").alias("a"), F.greatest("class", "o_class").alias("b")).distinct()


def linked_classes(df: DataFrame, key: str, text: str, sketch: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(node, component) of the classes that are linked with others.

    A bucket is left as soon as all its classes are in one component. First each class meets the leading class of a few
    buckets, then of all buckets; the classes of buckets that are still open then go through an exact prefix filter.
    So a large group of near copies never meets pair by pair.
    """
    found = df.sparkSession.createDataFrame([], "node bigint, component bigint")
    linked = None
    shared = _shared_rows(sketch)
    for step in ("few", "all", "rest"):
        placed = shared.where(F.col("band") < FIRST_BANDS) if step == "few" else shared
        placed = placed.join(found.withColumnRenamed("node", "class"), "class", "left")
        rows = _open_rows(placed.select("bucket", "class", F.coalesce("component", "class").alias("component")))
        size = rows.count()
        if not size:
            continue
        if step == "rest":
            wanted = rows.select("class").distinct()
            sets = _sets(df, key, text, sketch, wanted, wanted.count())
            pairs = materialize(_prefix_pairs(rows, sets, threshold), "prefix-pairs")
            count = pairs.count()
            pairs = materialize(few_tasks(_parted(pairs), count, TASK_ROWS), "parted-pairs")
        else:
            led = materialize(few_tasks(_lead_pairs(rows, size), size, TASK_ROWS), "lead-pairs")
            led = materialize(few_tasks(_parted(led), size, TASK_ROWS), "parted-pairs")
            pairs = materialize(few_tasks(_plausible(led, sketch, threshold), size, TASK_ROWS), "plausible-pairs")
            count = pairs.count()
            wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
            sets = _sets(df, key, text, sketch, wanted, 2 * count)
        new = _decided(pairs, sets, count, threshold)
        if new.isEmpty():
            continue
        linked = new if linked is None else linked.unionByName(new)
        found = materialize(components(linked), "components")
    return found


def near_classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """One row per input row: row, key, n_shingles, component_key, kept, text_hash.

    Rows are linked if their sets have a similarity of ``threshold`` or more; ``component_key`` is the least key reachable, and
    the row that has it stays (of repeated rows with that key, one). A null key is larger than any other. Rows without
    words (null, empty or blank texts) have an empty set, are linked with nothing and stay.
    """
    with batch_rows(df.sparkSession, BATCH_ROWS):
        rows = sketches(df, key, text)
        members, sketch = _classes(rows)
        found = linked_classes(df, key, text, sketch, threshold)
    joined = members.join(found.withColumnRenamed("node", "class"), "class", "left")
    joined = joined.select("row", "key", F.coalesce("component", "class").alias("component"))
    order = F.struct(F.col("key").isNull().alias("last"), F.col("key"), F.col("row"))
    least = materialize(joined.groupBy("component").agg(F.min(order).alias("least")), "least-keys")
    told = joined.join(least, "component").select("row", F.col("least.key").alias("component_key"), F.col("least.row").alias("first"))
    told = told.withColumn("told", F.lit(True))
    out = rows.select("row", "key", "n_shingles", "text_hash").join(told, "row", "left")
    return out.select(
        "row",
        "key",
        "n_shingles",
        F.when(F.col("told"), F.col("component_key")).otherwise(F.col("key")).alias("component_key"),
        F.coalesce(F.col("row") == F.col("first"), F.lit(True)).alias("kept"),
        "text_hash",
    )


def drop_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """The rows of ``df`` that stay, all columns as they are."""
    marks = materialize(near_classes(df, key, text, threshold).select("key", "text_hash", "kept"), "marks")
    return keep_marked(df, marks, key, text)
