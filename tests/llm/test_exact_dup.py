import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import exact_dup

LONG = "é" * 300 + "end"
ROWS = [
    (1, "a b"), (2, "a b"), (3, "A b"), (4, None), (5, ""), (6, LONG), (7, LONG + "x"), (8, LONG), (9, "a b"),
    (9, "a b"), (None, "a b"), (10, "a b "), (11, "abcdabcd"), (12, "abcd"), (13, "cdab" * 40), (14, "cdab" * 40), (9, "z"),
]


def _frame(spark, rows=ROWS):
    full = [(k, t, "clash", 1, 2) for k, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, key string, row int, hash int").repartition(3)


def _expected(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    return {
        (key, text): (max((k for k in groups[text or ""] if k is not None), default=None), len(groups[text or ""]))
        for key, text in rows
    }


@pytest.mark.parametrize("size, hashed", [(16384, F.xxhash64), (4, F.xxhash64), (4, lambda c: F.octet_length(c).cast("long")), (7, lambda c: F.lit(1).cast("long"))])
def test_groups_whatever_collides(spark, size, hashed):
    found = exact_dup.groups(_frame(spark), size=size, hashed=hashed).collect()
    expected = _expected(ROWS)
    assert len(found) == len(ROWS)
    by_sha = {hashlib.sha256((t or "").encode()).hexdigest(): t or "" for _, t in ROWS}
    kept = {}
    for r in found:
        text = by_sha[r.text_sha256]
        want = expected.get((r.key, text)) or expected[(r.key, None)]
        assert (r.keep_key, r.group_size) == want
        if r.kept:
            assert r.key == r.keep_key and text not in kept
            kept[text] = r.key
    assert set(kept) == set(by_sha.values())


def test_many_shared_hashes_take_the_content_along(spark, monkeypatch):
    monkeypatch.setattr(exact_dup, "SHARED_LIMIT", 0)
    found = exact_dup.groups(_frame(spark), size=4, hashed=lambda c: F.octet_length(c).cast("long")).collect()
    expected = _expected(ROWS)
    sizes = sorted(r.group_size for r in found)
    assert sizes == sorted(expected[row][1] for row in ROWS)


def test_rows_that_stay(spark):
    out = exact_dup.drop_duplicates(_frame(spark))
    assert out.columns == ["doc_id", "text", "key", "row", "hash"]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [
        (3, "A b"), (5, ""), (7, LONG + "x"), (8, LONG), (9, "a b"), (9, "z"), (10, "a b "), (11, "abcdabcd"),
        (12, "abcd"), (14, "cdab" * 40),
    ]


def test_empty_table(spark):
    assert exact_dup.groups(_frame(spark, [])).collect() == []
    assert exact_dup.drop_duplicates(_frame(spark, [])).collect() == []
