"""Benchmark passages in training documents, found through a stored positional inverted index.

The index is cut by documents: each shard holds the sorted positions of every term in a bounded run of documents, in
one row, so a phrase is looked up inside a shard and nothing is shuffled. Test items are windows of consecutive words,
read in bounded blocks. In a shard a window starts from the positions of its rarest term (by counts over the whole
index) and meets the lists of the other terms, rarest first: within a distance for proximity matches, then at the
exact offsets for phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .marks import drop_marked, text_hash
from .words import ALNUM_TABLE, slices

WINDOW = 13
NEAR = 26  # words that the terms of a proximity match may be away from the rarest one
SHARD_BYTES = 4 << 20  # text of one shard; a longer text is a shard of its own
BLOCK_WORDS = 1_000_000  # words of test items that are sent to the executors at a time
TERM_LIMIT = 2_000_000  # different test words that may restrict an index; with more, every term is indexed


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased from A to Z only."""
    return (text or "").encode().translate(ALNUM_TABLE).split()


def build_index(df: DataFrame, key: str = "doc_id", text: str = "text", terms: set[bytes] | None = None) -> DataFrame:
    """The stored index: one row per shard.

    shard, keys, hashes, n_words (per document of the shard), starts (position of each document's first word), terms, ends
    (where each term's positions end), positions. Documents stand more than ``NEAR`` words apart, so that no match
    crosses two. With ``terms`` only those are indexed. Null and empty texts have no words.
    """
    kind = df.schema[key].dataType.simpleString()
    shared = None if terms is None else df.sparkSession.sparkContext.broadcast(sorted(terms))
    schema = (
        f"shard bigint, keys array<{kind}>, hashes array<bigint>, n_words array<bigint>, starts array<bigint>,"
        "terms array<binary>, ends array<int>, positions array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        known_terms = None if shared is None else {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            for at, part in slices(batch.column(1), SHARD_BYTES):
                ids: dict[bytes, int] = {} if known_terms is None else known_terms
                found, place, counts, starts, begin = [], [], [], [], 0
                for item in part.to_pylist():
                    words = words_of(item)
                    if known_terms is None:
                        told = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int32)
                    else:
                        told = np.array([ids.get(w, -1) for w in words], dtype=np.int32)
                    known = np.flatnonzero(told >= 0)
                    found.append(told[known])
                    place.append(known + begin)
                    counts.append(len(words))
                    starts.append(begin)
                    begin += len(words) + NEAR + 1
                term, position = np.concatenate(found), np.concatenate(place)
                order = np.argsort(term, kind="stable")
                term, position = term[order], position[order]
                first = np.flatnonzero(np.diff(term, prepend=-1))
                names = list(ids) if shared is None else shared.value
                rows, marks = (batch.column(c).slice(at, len(counts)) for c in (0, 2))
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int64()),
                        one(rows),
                        one(marks),
                        one(pa.array(counts, pa.int64())),
                        one(pa.array(starts, pa.int64())),
                        one(pa.array([names[i] for i in term[first].tolist()], pa.binary())),
                        one(pa.array(np.append(first[1:], len(term))[: len(first)].astype(np.int32))),
                        one(pa.array(position.astype(np.int32))),
                    ],
                    ["shard", "keys", "hashes", "n_words", "starts", "terms", "ends", "positions"],
                )
                shard += 1

    narrow = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), text_hash(F.col(text)))
    return materialize(narrow.mapInArrow(run, schema), "positional-index")


def term_counts(index: DataFrame) -> DataFrame:
    """(term, n): how often each term stands in the whole index."""
    lists = F.arrays_zip("terms", "ends", F.concat(F.array(F.lit(0)), F.col("ends")).alias("begins"))
    each = index.select(F.explode(lists).alias("t")).where("t.terms IS NOT NULL")
    return each.groupBy(F.col("t.terms").alias("term")).agg(F.sum(F.col("t.ends") - F.col("t.begins")).alias("n"))


Item = tuple[str, list[bytes]]


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[Item]]:
    """Test items with their words, a bounded number of words at a time."""
    block: list[Item] = []
    size = 0
    for row in items.select(F.col(key).cast("string"), F.col(text).cast("string")).toLocalIterator():
        words = words_of(row[1])
        if words:
            block.append((row[0], words))
            size += len(words)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _windows(block: list[Item], counts: dict[bytes, int]) -> list[tuple[int, int, int, list[tuple[bytes, int]]]]:
    """(item number, offset in the item, length, [(term, offset in the window), rarest term first]).

    Equal windows of an item are listed once; windows with a term that the index lacks are left out.
    """
    out = []
    for number, (_, words) in enumerate(block):
        seen = set()
        length = min(WINDOW, len(words))
        for at in range(len(words) - length + 1):
            window = tuple(words[at : at + length])
            if window in seen or not all(w in counts for w in window):
                continue
            seen.add(window)
            terms = sorted(((w, i) for i, w in enumerate(window)), key=lambda t: (counts[t[0]], t[0], t[1]))
            out.append((number, at, length, terms))
    return out


def _has(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


def _close(sorted_values: np.ndarray, values: np.ndarray, distance: int) -> np.ndarray:
    """Whether some sorted value is at most ``distance`` away from each value."""
    at = np.searchsorted(sorted_values, values - distance)
    at = np.minimum(at, len(sorted_values) - 1)
    return np.abs(sorted_values[at] - values) <= distance


def _by_rarest(windows) -> dict[bytes, list]:
    """The windows of each term that is the rarest of one."""
    out: dict[bytes, list] = {}
    for window in windows:
        out.setdefault(window[3][0][0], []).append(window)
    return out


def _in_shard(by: dict[bytes, list], postings: dict[bytes, np.ndarray]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(item number, window length, places of the rarest term with the others near, starts of exact phrases).

    Only windows whose rarest term stands in the shard are looked at.
    """
    for number, _, length, terms in (w for t in postings if t in by for w in by[t]):
        rarest, offset = terms[0]
        near = postings[rarest]
        for term in dict.fromkeys(t for t, _ in terms[1:]):
            other = postings.get(term)
            near = near[:0] if other is None else near[_close(other, near, NEAR)]
            if not len(near):
                break
        if not len(near):
            continue
        start = near - offset
        for term, at in terms[1:]:
            start = start[_has(postings[term], start + at)]
            if not len(start):
                break
        yield number, length, near, start


def search(index: DataFrame, items: DataFrame, item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Matches of every item in every document: shard, doc, item (text), kind, first, last.

    ``doc`` is the number of the document in its shard; ``first`` and ``last`` are word positions in the document (last
    exclusive). kind is ``phrase``, with overlapping windows of one item merged, or ``near``: the place of a window's
    rarest term that has all its other terms within ``NEAR`` words.
    """
    spark = index.sparkSession
    counts_table = materialize(term_counts(index), "term-counts")
    out = None
    for block in _blocks(items, item_key, item_text):
        wanted = sorted({w for _, words in block for w in words})
        names = spark.createDataFrame([(bytearray(w),) for w in wanted], "term binary")
        # at most BLOCK_WORDS rows come back
        counts = {bytes(r[0]): r[1] for r in counts_table.join(F.broadcast(names), "term", "left_semi").collect()}
        shared = spark.sparkContext.broadcast((_windows(block, counts), [name for name, _ in block]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows, names = shared.value
            by = _by_rarest(windows)
            wanted = {t for _, _, _, terms in windows for t, _ in terms}
            for batch in batches:
                for i in range(batch.num_rows):
                    array = lambda c: batch.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: E731,B023
                    shard, starts = batch.column("shard")[i].as_py(), array("starts")
                    positions, ends = array("positions").astype(np.int64), array("ends")
                    begins = np.concatenate([[0], ends[:-1]])
                    postings = {
                        t: positions[a:b]
                        for t, a, b in zip(batch.column("terms")[i].values.to_pylist(), begins.tolist(), ends.tolist())
                        if t in wanted
                    }
                    rows = {"doc": [], "item": [], "kind": [], "first": [], "last": []}
                    phrases: dict[int, list[tuple[np.ndarray, int]]] = {}
                    nears: dict[int, list[np.ndarray]] = {}
                    for number, length, near, start in _in_shard(by, postings):
                        nears.setdefault(number, []).append(near)
                        if len(start):
                            phrases.setdefault(number, []).append((start, length))
                    spans = []
                    for number, found in phrases.items():
                        first = np.unique(np.concatenate([s for s, _ in found]))
                        length = found[0][1]
                        new = np.flatnonzero(np.diff(first, prepend=-length - 1) > length)
                        last = first[np.append(new[1:], len(first)) - 1] + length
                        spans += [(number, "phrase", a, b) for a, b in zip(first[new].tolist(), last.tolist())]
                    for number, found in nears.items():
                        spans += [(number, "near", a, a + 1) for a in np.unique(np.concatenate(found)).tolist()]
                    for number, kind, a, b in spans:
                        doc = int(np.searchsorted(starts, a, "right")) - 1
                        rows["doc"].append(doc)
                        rows["item"].append(names[number])
                        rows["kind"].append(kind)
                        rows["first"].append(a - int(starts[doc]))
                        rows["last"].append(b - int(starts[doc]))
                    if rows["doc"]:
                        told = [pa.array(rows[c], t) for c, t in zip(rows, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()))]
                        yield pa.RecordBatch.from_arrays([pa.array([shard] * len(rows["doc"]), pa.int64()), *told], ["shard", *rows])

        schema = "shard bigint, doc int, item string, kind string, first bigint, last bigint"
        part = index.select("shard", "starts", "terms", "ends", "positions").mapInArrow(run, schema)
        part = materialize(part, "matches")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "shard bigint, doc int, item string, kind string, first bigint, last bigint")
    return out


def item_terms(items: DataFrame, text: str = "text") -> set[bytes] | None:
    """The different words of the test items, or None if they are more than ``TERM_LIMIT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {w for item in batch.column(0).to_pylist() for w in words_of(item)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], ["term"])

    words = items.select(F.col(text).cast("string")).mapInArrow(run, "term binary").distinct()
    found = words.limit(TERM_LIMIT + 1).collect()
    return {bytes(r[0]) for r in found} if len(found) <= TERM_LIMIT else None


def contamination(
    df: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items (sorted), contaminated, n_near, text_hash.

    A word is hit if it stands in an occurrence of a window of 13 consecutive words of an item (of all its words, if it
    has fewer). A document is contaminated if at least a twentieth of its words is hit. ``n_near`` counts the items
    with a proximity match. Documents or items without words match nothing.
    """
    index = build_index(df, key, text, item_terms(items, item_text))
    found = materialize(search(index, items, item_key, item_text).where("last > first"), "all-matches")
    doc = ["shard", "doc"]
    before = Window.partitionBy(*doc).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    phrase = found.where("kind = 'phrase'").withColumn("reached", F.coalesce(F.max("last").over(before), F.lit(0)))
    hit = phrase.groupBy(*doc).agg(
        F.sum(F.greatest(F.lit(0), F.col("last") - F.greatest("first", "reached"))).alias("n_hit"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    near = found.where("kind = 'near'").groupBy(*doc).agg(F.count_distinct("item").alias("n_near"))
    each = index.select("shard", F.posexplode(F.arrays_zip("keys", "hashes", "n_words")).alias("doc", "d"))
    each = each.select("shard", "doc", F.col("d.keys").alias("key"), "d.hashes", "d.n_words")
    out = each.join(materialize(hit, "hits"), doc, "left").join(materialize(near, "near-hits"), doc, "left")
    out = out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "key",
        "n_words",
        "n_hit",
        F.size(items_of).cast("long").alias("n_items"),
        items_of.alias("items"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("hashes").alias("text_hash"),
    )


def drop_contaminated(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that are not contaminated, all columns as they are."""
    found = contamination(df, items, key, text, **options)
    marks = found.select("key", "text_hash", (~F.col("contaminated")).alias("kept"))
    return drop_marked(df, materialize(marks, "marks"), key, text)
