"""Licence notices by diagonal voting.

The hashes of all neighbouring word pairs of the documents are joined to the places of the same pairs in the templates.
Pairs that belong to one copy of a template lie on one diagonal (place in the document less place in the template), so
votes are counted by diagonal; diagonals a few words apart are merged, since a copy may have lost or gained words; what
has enough votes is verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .marks import text_hash
from .words import ALNUM, ALNUM_TABLE, grams, slices, word_hashes

# Phrases that are reported wherever their words stand, and the label of each.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Sentences of public licences, reported also where some words differ, and the label of each.
NOTICES = [
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
]

PAIR = 2
DRIFT = 3  # words between diagonals that are merged
COVERAGE = 0.8  # share of a notice's words that must be found when it is verified
# The word that tells a short notice from those of other licences, so that it must not differ.
NAMING = {"lgpl": "lesser", "agpl": "affero", "apache": "apache", "cc-by-nc": "nc"}
BROADCAST_ROWS = 200_000  # documents with matches that may be looked up by a broadcast table; more are shuffled

Template = tuple[str, str, bool]


def templates() -> list[Template]:
    """(text, label, whether every word must stand there)."""
    return [(t, label, True) for t, label in PHRASES] + [(t, label, False) for t, label in NOTICES]


def _template_pairs(spark: SparkSession, known: list[Template]) -> DataFrame:
    """(gram, template, at): as many rows as the fixed templates have pairs."""
    rows = []
    for number, (text, _, _) in enumerate(known):
        values, counts = word_hashes(pa.array([text]), ALNUM)
        hashed, _, at = grams(values, counts, PAIR)
        rows += [(int(h), number, int(i)) for h, i in zip(hashed.view(np.int64), at)]
    return spark.createDataFrame(rows, "gram bigint, template int, at int")


def least_votes(n: int) -> int:
    """Pairs that a copy of a notice of ``n`` words keeps at least if verification accepts it.

    A changed word breaks two pairs at most.
    """
    return n - 1 - 2 * int(n * (1 - COVERAGE) + 1e-9)


def pair_hashes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, grams array<bigint>): the hashes of all neighbouring words of each row, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                values, counts = word_hashes(texts, ALNUM)
                hashed, row, _ = grams(values, counts, PAIR)
                stops = np.searchsorted(row, np.arange(len(counts) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(stops), pa.array(hashed.view(np.int64)))
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), lists], ["key", "text_hash", "grams"])

    narrow = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), text_hash(F.col(text)))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"key {kind}, text_hash bigint, grams array<bigint>")


def candidates(df: DataFrame, key: str, text: str, known: list[Template]) -> DataFrame:
    """(key, text_hash, spans): for rows with enough votes, [(template, first word, last word exclusive)].

    Votes are sets of template places, so that repeated rows do not vote twice. A span covers the whole template on its
    diagonals, also where the words at its ends differ; it may reach over the ends of the text.
    """
    doc = ["key", "text_hash"]
    pairs = F.broadcast(_template_pairs(df.sparkSession, known))
    placed = pair_hashes(df, key, text).select(*doc, F.posexplode("grams").alias("pos", "gram")).join(pairs, "gram")
    diagonals = placed.groupBy(*doc, "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("votes")
    )
    diagonals = materialize(diagonals, "diagonals")
    full = F.lit(0)
    words = F.lit(0)
    least = F.lit(0)
    for number, (phrase, _, _) in enumerate(known):
        n = len(phrase.split())
        full = F.when(F.col("template") == number, n - PAIR + 1).otherwise(full)
        words = F.when(F.col("template") == number, n).otherwise(words)
        least = F.when(F.col("template") == number, least_votes(n)).otherwise(least)
    exact = F.col("template").isin([i for i, t in enumerate(known) if t[2]])
    whole = diagonals.where(exact & (F.size("votes") == full)).select(
        *doc, "template", F.col("diagonal").alias("first"), (F.col("diagonal") + words).alias("last")
    )
    ordered = Window.partitionBy(*doc, "template").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(ordered) <= DRIFT, 0).otherwise(1)
    merged = diagonals.where(~exact).withColumn("new", apart)
    merged = merged.withColumn("copy", F.sum("new").over(ordered)).groupBy(*doc, "template", "copy").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("votes")))).alias("votes"),
        F.min("diagonal").alias("first"),
        (F.max("diagonal") + words).alias("last"),
    )
    merged = merged.where(F.col("votes") >= least).select(*doc, "template", "first", "last")
    spans = whole.unionByName(merged).groupBy(*doc).agg(F.collect_set(F.struct("template", "first", "last")).alias("spans"))
    return materialize(spans, "licence-spans")


def _similar(words: list[bytes], template: list[bytes]) -> tuple[float, int, int]:
    """The share of the template's words that stand in the words, in order, and from where to where."""
    blocks = [b for b in SequenceMatcher(None, words, template, autojunk=False).get_matching_blocks() if b.size]
    if not blocks:
        return 0.0, 0, 0
    return sum(b.size for b in blocks) / len(template), blocks[0].a, blocks[-1].a + blocks[-1].size


def _verified(words: list[bytes], spans: list[dict], known: list[Template], plain: list[list[bytes]]) -> list[tuple]:
    """(first, last, label, share, whether it is a phrase) of the spans that hold, in order.

    A notice whose words another licence's template fits better is left out: the GPL's phrase is not a shortened LGPL.
    """
    found = []
    for span in sorted(spans, key=lambda s: (s["first"], s["template"])):
        template, (_, label, exact) = plain[span["template"]], known[span["template"]]
        begin = max(0, span["first"])
        part = words[begin : max(0, span["last"])]
        if exact:
            if part == template:
                found.append((begin, begin + len(part), label, 1.0, True))
            continue
        share, first, last = _similar(part, template)
        if share >= COVERAGE and (label not in NAMING or NAMING[label].encode() in part[first:last]):
            found.append((begin + first, begin + last, label, share, False))
    best = sorted(found, key=lambda f: -f[3])
    return [
        f for f in found
        if f[3] == 1 or not any(o[3] > f[3] and o[2] != f[2] and o[0] <= f[0] and f[1] <= o[1] for o in best)
    ]


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``n_base`` counts the places of the phrases, first and last word are their smallest and largest start (null without
    any). ``labels`` adds those of the notices; ``score`` is the best verified share of a template, 0 without any.
    ``spans`` lists label:first:last (words, last exclusive). Null and empty texts have no words.
    """
    known = templates()
    found = candidates(df, key, text, known).withColumnRenamed("key", "found_key").withColumnRenamed("text_hash", "found_hash")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), text_hash(F.col(text)).alias("text_hash"))
    same = rows["key"].eqNullSafe(found["found_key"]) & (rows["text_hash"] == found["found_hash"])
    joined = rows.join(found, same, "left").select("key", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = [t.encode().split() for t, _, _ in known]
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                spans = batch.column(2).slice(at, len(texts)).to_pylist()
                out: dict[str, list] = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
                for item, listed in zip(texts.to_pylist(), spans):
                    words = (item or "").encode().translate(ALNUM_TABLE).split()
                    verified = _verified(words, listed or [], known, plain)
                    base = [(first, label) for first, _, label, _, exact in verified if exact]
                    told = [(label, first, last) for first, last, label, _, _ in verified]
                    best = max((share for _, _, _, share, _ in verified), default=0.0)
                    starts = [s for s, _ in base]
                    out["n_words"].append(len(words))
                    out["n_base"].append(len(base))
                    out["first_word"].append(min(starts, default=None))
                    out["last_word"].append(max(starts, default=None))
                    out["base_labels"].append(",".join(sorted({label for _, label in base})))
                    out["labels"].append(",".join(sorted({label for label, _, _ in told})))
                    out["score"].append(best)
                    out["spans"].append([f"{label}:{a}:{b}" for label, a, b in told])
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
                columns = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *columns], ["key", *out])

    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
        "labels string, score double, spans array<string>"
    )
    return joined.mapInArrow(run, schema)
