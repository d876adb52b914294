import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import words

TEXTS = ["Ab c-d", None, "", "É à  b c 12x", " lead and trail ", "x" * 5000, "one", "\x00\x0b\t.", "日本 語"]


def _expected(text, pattern):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(pattern, lowered)


@pytest.mark.parametrize(
    "table, pattern", [(words.ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), (words.NOT_SPACE, "[^\x20\x09-\x0d]+")]
)
@pytest.mark.parametrize("window", [8, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, table, pattern, window):
    monkeypatch.setattr(words, "WINDOW", window)
    monkeypatch.setattr(words, "_tables", {})
    column = pa.array(TEXTS)
    values, counts = words.word_hashes(column, table)
    expected = [_expected(t, pattern) for t in TEXTS]
    assert counts.tolist() == [len(e) for e in expected]
    flat = [w for e in expected for w in e]
    by_word = {}
    for word, value in zip(flat, values.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_sliced_and_large_columns_read_the_same():
    column = pa.array(TEXTS)
    whole, _ = words.word_hashes(column.slice(3, 4), words.ALNUM)
    large, _ = words.word_hashes(column.cast(pa.large_string()).slice(3, 4), words.ALNUM)
    assert whole.tolist() == large.tolist() == words.word_hashes(pa.array(TEXTS[3:7]), words.ALNUM)[0].tolist()


def test_byte_table_gives_the_same_words():
    for text in TEXTS:
        split = (text or "").encode().translate(words.ALNUM_TABLE).split()
        assert [w.decode() for w in split] == _expected(text, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def test_slices_cover_all_rows_once():
    column = pa.array(["a" * 10] * 7 + [None, "b" * 100, ""])
    found = list(words.slices(column, 25))
    assert [at for at, _ in found] == np.cumsum([0] + [len(p) for _, p in found[:-1]]).tolist()
    assert sum((p.to_pylist() for _, p in found), []) == column.to_pylist()


def test_grams_stay_in_their_row():
    values, counts = words.word_hashes(pa.array(["a b c", "a b", "c", None]), words.ALNUM)
    hashed, rows, at = words.grams(values, counts, 2)
    assert rows.tolist() == [0, 0, 1] and at.tolist() == [0, 1, 0]
    assert hashed[0] == hashed[2] != hashed[1]
