"""Byte-pair encoding and decoding by a deterministic automaton over tokens.

The automaton starts with one state that every byte leads back to. Each merge (u, v), in order, applies one gadget:
arcs labelled u are sent to a copy of their target that lacks the arc v, and every state that had an arc u gets an arc
uv to the old target of v. A token string is the encoding of its word exactly if the automaton accepts it. All arcs of
one label have one target, so a state is named by the label that leads to it.

Writing every arc out would need one entry per pair (tens of millions are missing after 50,000 merges), so a copy
keeps only its gadget: what it was copied from, which arc it lacks, and when. ``Automaton.has_arc`` follows those.
Reading a word byte by byte, a transition table over the labels gives the longest label that ends at each byte, and
the state reached there is the one label whose arc leaves the state reached where that label begins.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import slices

CACHE_WORDS = 300_000  # words whose encoding one worker remembers: bounds memory, not results
LOCKSTEP = 48  # longer words are read one at a time
NEVER = np.int64(1) << 40


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {chr(b): b for b in plain}
    names.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return names


LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
# What follows an apostrophe that starts a word of its own.
ONE_LETTER, TWO_LETTERS = ("s", "t", "m", "d"), ("re", "ve", "ll")


@functools.cache
def _classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    out = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for found in regex.finditer(pattern, every):
            out[ord(found[0][0]) : ord(found[0][-1]) + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


def split_words(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The words that byte-level merging works on, in UTF-8, and the number of them in each text.

    Runs of letters, numbers, other characters or white space; one space goes with the run behind it, other white
    space in front of a run ends in a word of one character; an apostrophe takes its contraction with it.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    whole = "".join(texts)
    point = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    if not len(point):
        return [], np.zeros(len(texts), dtype=np.int64)
    kind = _classes()[point]
    first = np.cumsum(sizes) - sizes
    text_start = np.zeros(len(point) + 3, dtype=bool)
    text_start[first[sizes > 0]] = True
    text_start[len(point) :] = True
    start = text_start[: len(point)].copy()
    start[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & ~text_start[1 : len(point)]) + 1
    start[run - 1] = True
    start[run[point[run - 1] == 0x20]] = False
    mark = np.flatnonzero((point == ord("'")) & start)
    mark = mark[~text_start[mark + 1]]
    mark = mark[(kind[mark + 1] == LETTER) & start[mark + 1]]
    if len(mark):
        padded = np.concatenate([point, np.zeros(3, dtype=np.uint32)])
        padded_kind = np.concatenate([kind, np.zeros(3, dtype=np.uint8)])
        one = np.isin(padded[mark + 1], [ord(c) for c in ONE_LETTER])
        pair = (padded[mark + 1].astype(np.uint64) << np.uint64(32)) | padded[mark + 2]
        two = np.isin(pair, np.array([(ord(a) << 32) | ord(b) for a, b in TWO_LETTERS], dtype=np.uint64))
        two &= ~one & ~text_start[mark + 2]
        for which, width in ((one, 2), (two, 3)):
            at = mark[which]
            start[at + 1] = False
            rest = at[~text_start[at + width] & (padded_kind[at + width] == LETTER)] + width
            start[rest] = True
    begin = np.flatnonzero(start)
    counts = np.diff(np.searchsorted(begin, np.concatenate([first, [len(point)]])))
    if len(whole.encode()) == len(point):
        data, edges = whole.encode(), begin.tolist()
    else:
        width = 1 + (point > 0x7F).astype(np.int64) + (point > 0x7FF) + (point > 0xFFFF)
        data, edges = whole.encode(), (np.cumsum(width) - width)[begin].tolist()
    edges.append(len(data))
    return [data[a:b] for a, b in zip(edges, edges[1:])], counts


class Automaton:
    """Compiled from a byte-level BPE vocabulary file (``path``) of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, byte = spec["model"]["vocab"], _byte_names()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.labels = [b""] * size
        for name, token in vocab.items():
            self.labels[token] = bytes(byte[c] for c in name)
        for name, token in self.specials.items():
            self.labels[token] = name.encode()
        self.length = np.array([len(x) for x in self.labels], dtype=np.int64)
        self._compile([(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]], size)
        self._table([vocab[name] for name in vocab])
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.cache: dict[bytes, bytes] = {}

    # ------------------------------------------------------------ compiling
    def _compile(self, merges: list[tuple[int, int, int]], size: int) -> None:
        """One gadget per merge: when it was made, the label it extends on either side, and the arc it removes."""
        self.time = np.zeros(size, dtype=np.int64)  # bytes exist from the start
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        removed = {}
        for when, (u, v, uv) in enumerate(merges, 1):
            self.time[uv], self.left[uv], self.right[uv] = when, u, v
            removed.setdefault((u << 32) | v, when)
        keys = np.array(sorted(removed), dtype=np.int64)
        bits = max(4, (2 * len(keys)).bit_length() + 1)
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key = np.full(1 << bits, -1, dtype=np.int64)
        self.slot_time = np.full(1 << bits, NEVER, dtype=np.int64)
        at = self._slot(keys)
        for key, slot in zip(keys.tolist(), at.tolist()):
            while self.slot_key[slot] >= 0:
                slot = (slot + 1) & self._mask
            self.slot_key[slot], self.slot_time[slot] = key, removed[key]
        self.removed = removed

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _removal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """When the arc y was removed behind x, or NEVER."""
        keys = (x << 32) | y
        slot = self._slot(keys)
        found = self.slot_key[slot]
        out = np.where(found == keys, self.slot_time[slot], NEVER)
        open_ = np.flatnonzero((found >= 0) & (found != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self._mask
            found = self.slot_key[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_time[slot[open_[hit]]]
            open_ = open_[(found >= 0) & ~hit]
        return out

    def has_arc(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the state that x leads to has an arc y, for many pairs at once.

        The younger of the state's gadget and the label is undone step by step; the arc is missing if it was removed
        while both were as they stand at that step.
        """
        x, y = x.copy(), y.copy()
        ok = np.ones(len(x), dtype=bool)
        until = np.full(len(x), NEVER - 1, dtype=np.int64)
        live = np.arange(len(x))
        while len(live):
            gone = self._removal(x, y) < until
            ok[live[gone]] = False
            tx, ty = self.time[x], self.time[y]
            keep = ~gone & ((tx > 0) | (ty > 0))
            live, x, y, tx, ty = live[keep], x[keep], y[keep], tx[keep], ty[keep]
            back = tx > ty
            until = np.where(back, tx, ty + 1)
            x = np.where(back, self.right[x], x)
            y = np.where(back, y, self.left[y])
        return ok

    def _has_arc(self, x: int, y: int) -> bool:
        until = NEVER
        while True:
            if self.removed.get((x << 32) | y, NEVER) < until:
                return False
            tx, ty = int(self.time[x]), int(self.time[y])
            if not tx and not ty:
                return True
            if tx > ty:
                until, x = tx, int(self.right[x])
            else:
                until, y = ty + 1, int(self.left[y])

    def _table(self, tokens: list[int]) -> None:
        """The transition table: after each byte, the longest label that ends there, and the next shorter one of each."""
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for token in tokens:
            node = 0
            for b in self.labels[token]:
                step = children[node].get(b)
                if step is None:
                    step = children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = step
            ends[node] = token
        self.next = np.zeros((len(children), 256), dtype=np.int32)
        self.longest = np.array(ends, dtype=np.int64)
        self.shorter = np.full(len(self.labels), -1, dtype=np.int64)
        fail = [0] * len(children)
        level = [0]
        while level:
            below = []
            for node in level:
                row = self.next[node]
                if node:
                    row[:] = self.next[fail[node]]
                for b, child in children[node].items():
                    fail[child] = int(row[b]) if node else 0
                    row[b] = child
                    below.append(child)
            for child in below:
                shorter = self.longest[fail[child]]
                if self.longest[child] >= 0:
                    self.shorter[self.longest[child]] = shorter
                else:
                    self.longest[child] = shorter
            level = below

    # ------------------------------------------------------------ encoding
    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-split word, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        size = np.array([len(w) for w in words], dtype=np.int64)
        for i in np.flatnonzero(size > LOCKSTEP).tolist():
            out[i] = self._encode_long(words[i])
        order = np.flatnonzero((size > 0) & (size <= LOCKSTEP))
        order = order[np.argsort(-size[order], kind="stable")]
        if not len(order):
            return out
        data = np.frombuffer(b"".join([words[i] for i in order.tolist()]), dtype=np.uint8)
        size = size[order]
        first = np.cumsum(size) - size
        reached = np.zeros(len(data), dtype=np.int64)  # the label that leads to the state after each byte
        state = np.zeros(len(order), dtype=np.int32)
        for i in range(int(size[0])):
            n = int(np.searchsorted(-size, -i, "left"))  # words longer than i stand in front
            at = first[:n] + i
            state = self.next[state[:n], data[at]]
            label = self.longest[state]
            begin = i + 1 - self.length[label]
            open_ = np.flatnonzero(begin > 0)
            while len(open_):
                bad = ~self.has_arc(reached[first[open_] + begin[open_] - 1], label[open_])
                open_ = open_[bad]
                label[open_] = self.shorter[label[open_]]
                begin[open_] = i + 1 - self.length[label[open_]]
                open_ = open_[begin[open_] > 0]
            reached[at] = label
        rest, used = size.copy(), []
        live = np.arange(len(order))
        while len(live):
            label = reached[first[live] + rest[live] - 1]
            used.append((live, label))
            rest[live] -= self.length[label]
            live = live[rest[live] > 0]
        who = np.concatenate([w for w, _ in used])
        step = np.concatenate([np.full(len(w), k) for k, (w, _) in enumerate(used)])
        ids = np.concatenate([label for _, label in used])[np.lexsort((-step, who))].astype("<u4").tobytes()
        stop = (np.cumsum(np.bincount(who, minlength=len(order))) * 4).tolist()
        begin_ = 0
        for i, end in zip(order.tolist(), stop):
            out[i] = ids[begin_:end]
            begin_ = end
        return out

    def _encode_long(self, word: bytes) -> bytes:
        reached: list[int] = []
        state, table, longest = 0, self.next, self.longest
        for i, b in enumerate(word):
            state = table[state, b]
            label = int(longest[state])
            begin = i + 1 - len(self.labels[label])
            while begin > 0 and not self._has_arc(reached[begin - 1], label):
                label = int(self.shorter[label])
                begin = i + 1 - len(self.labels[label])
            reached.append(label)
        ids, at = [], len(word)
        while at:
            ids.append(reached[at - 1])
            at -= len(self.labels[ids[-1]])
        return np.array(ids[::-1], dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts, as little-endian 32-bit integers; special tokens in a text are recognised."""
        known = self.cache
        if len(known) > CACHE_WORDS:
            known.clear()
        parts = [self._segments(t) for t in texts]
        flat = [p for text in parts for p in text]
        words, counts = split_words(["" if p in self.specials else p for p in flat])
        new = list({w for w in words if w not in known})
        known.update(zip(new, self.encode_words(new)))
        ids = [known[w] for w in words]
        stop = np.cumsum(counts).tolist()
        begin, at, out = 0, 0, []
        for text in parts:
            pieces: list[bytes] = []
            for part in text:
                end = stop[at]
                pieces += ids[begin:end]
                if part in self.specials:
                    pieces.append(np.array([self.specials[part]], dtype="<u4").tobytes())
                begin, at = end, at + 1
            out.append(b"".join(pieces))
        return out

    def _segments(self, text: str) -> list[str]:
        if any(s in text for s in self.specials):
            return self.split_special.split(text)
        return [text]

    # ------------------------------------------------------------ decoding
    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8: the labels of the arcs in order; bytes that are no UTF-8 are replaced."""
        labels = self.labels
        text = b"".join([labels[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
        return text.decode("utf-8", "replace").encode()


_compiled: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file, compiled once per process."""
    if path not in _compiled:
        _compiled[path] = Automaton(path)
    return _compiled[path]


@contextmanager
def automaton_while(path: str):
    """The automaton for one task. A Python worker lives on and runs the tasks of other steps: what it compiled and the
    words that it remembered (above 150 MB) would be held beside their work."""
    try:
        yield automaton(path)
    finally:
        _compiled.pop(path, None)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out`` (array of int): the token ids of every whole text. Null texts count as empty: no tokens.

    ``path`` names a vocabulary file that every executor has. Any other columns, whatever their names, are kept; an
    existing column ``out`` is replaced.
    """
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with automaton_while(path) as auto:
            for batch in batches:
                for at, texts in slices(batch.column(batch.schema.get_field_index(text))):
                    ids = auto.encode([t or "" for t in texts.to_pylist()])
                    stops = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                    flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                    rows = batch.select(kept).slice(at, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.ListArray.from_arrays(pa.array(stops), flat)], [*kept, out]
                    )

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of the token ids; a null list counts as empty. Unknown ids are an error."""
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with automaton_while(path) as auto:
            for batch in batches:
                column = batch.column(batch.schema.get_field_index(ids))
                texts = [
                    auto.decode(np.array(x or [], dtype="<u4").tobytes()).decode() for x in column.to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(kept).columns, pa.array(texts, pa.string())], [*kept, out]
                )

    return df.mapInArrow(run, schema)


def digest(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: key, n_tokens, ids_sha256, decoded_sha256, round_trip, one row per input row.

    ``with_ids`` adds the ids themselves (array of int).
    """
    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
            T.StructField("round_trip", T.BooleanType()),
            *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with automaton_while(path) as auto:
            for batch in batches:
                for at, texts in slices(batch.column(1), 1 << 20):
                    plain = [t or "" for t in texts.to_pylist()]
                    ids = auto.encode(plain)
                    back = [auto.decode(x) for x in ids]
                    lists = []
                    if with_ids:
                        stops = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                        lists = [pa.ListArray.from_arrays(pa.array(stops), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(at, len(texts)),
                            pa.array([len(x) // 4 for x in ids], pa.int64()),
                            pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                            pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                            pa.array([x == t.encode() for x, t in zip(back, plain)]),
                            *lists,
                        ],
                        schema.names,
                    )

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)
