"""Words and word hashes of whole Arrow text columns, computed on the raw UTF-8 bytes.

No function here looks at more than ``WINDOW`` bytes at a time, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20  # bytes hashed at a time: bounds memory, not the text

_rng = np.random.default_rng(20240611)
_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Digits, ASCII letters and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Everything but space and the control characters tab to carriage return.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[0x20] = NOT_SPACE[0x09:0x0E] = False

#: ``text.translate(ALNUM_TABLE).split()`` gives the lower-cased ALNUM words of a byte string.
ALNUM_TABLE = bytes(int(_LOWER[b]) if ALNUM[b] else 0x20 for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least ``n`` positions."""
    if n <= WINDOW + 1:
        n = WINDOW + 1
    if n not in _tables:
        made = _powers(_BASE, n), _powers(_INVERSE, n)
        if n > WINDOW + 1:
            return made
        _tables[n] = made
    return _tables[n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, dtype=np.uint8)
    return data, offsets - offsets[0]


def slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows with about ``limit`` bytes of text each: (first row, rows); one long text is a run of its own."""
    _, offsets = raw(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, column.slice(at, end - at)
        at = end


def bounds(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; a word never crosses two rows."""
    is_word = word[data]
    edge = is_word.copy()
    edge[1:] &= ~is_word[:-1]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    edge[first] = is_word[first]
    starts = np.flatnonzero(edge)
    edge[:] = is_word
    edge[:-1] &= ~is_word[1:]
    edge[last] = is_word[last]
    return starts, np.flatnonzero(edge) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each lower-cased (A-Z only) word."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        end = max(at + 1, int(np.searchsorted(ends, begin + WINDOW, "right")))
        stop = int(ends[end - 1])
        power, inverse = _tables_of(stop - begin + 1)
        total = np.zeros(stop - begin + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[_LOWER[data[begin:stop]]] * power[: stop - begin], out=total[1:])
        s, e = starts[at:end] - begin, ends[at:end] - begin
        out[at:end] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = end
    return out


def word_hashes(column: pa.Array, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the rows, and the number of words in each row."""
    data, offsets = raw(column)
    starts, ends = bounds(data, offsets, word)
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes(data, starts, ends), counts


def hash_of(text: str) -> int:
    """The hash of one word."""
    value, _ = word_hashes(pa.array([text]), np.ones(256, dtype=bool))
    return int(value[0])


def grams(values: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words of a row: (hashes, row of each, position of each in its row)."""
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    at = np.arange(len(values)) - np.repeat(first, counts)
    keep = np.flatnonzero(at + n <= np.repeat(counts, counts))
    out = values[keep]
    with np.errstate(over="ignore"):
        for i in range(1, n):
            out = mix(out * _BASE + values[keep + i])
    return out, rows[keep], at[keep]
