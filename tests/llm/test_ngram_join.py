import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import ngram_join
from ledgerlens.llm.words import NOT_SPACE


def grams(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < 3:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(len(words) - 2))


def brute(rows, least=90):
    sets = [(k, grams(t)) for k, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= least * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    lowest = {}
    for i, (k, _) in enumerate(sets):
        order = (k is None, k or 0)
        lowest[find(i)] = min(order, lowest.get(find(i), order))
    return sorted((k is None, k or 0, len(s), lowest[find(i)][0], lowest[find(i)][1]) for i, (k, s) in enumerate(sets))


def told(found):
    return sorted((r.key is None, r.key or 0, r.n_shingles, r.component_key is None, r.component_key or 0) for r in found)


def random_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (None, "one two"), (4, "one two")]
    key = 10
    passage = [rng.choice(words) for _ in range(60)]
    for _ in range(24):
        base = [rng.choice(words) for _ in range(rng.choice([6, 12, 40, 150, 400]))]
        if rng.random() < 0.4:
            base += passage
        for edits in (0, 0, 1, 1, 2, 3, 5, 8, 12):
            text = list(base)
            for _ in range(edits):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((key, " ".join(text)))
            key += 1
    chain = [rng.choice(words) for _ in range(300)]
    for step in range(30):
        chain[step * 9] = f"changed{step}"
        rows.append((key, " ".join(chain)))
        key += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_components_match_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, many copies of a leader, no broadcast
        monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 3)
        monkeypatch.setattr(ngram_join, "PARTNERS", 2)
        monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 1)
    rows = random_rows()
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, row int, tile string").repartition(4)
    assert told(ngram_join.join_classes(df).collect()) == brute(rows)


def test_other_thresholds(spark):
    rows = [r for r in random_rows() if (r[0] or 0) < 120]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (80, 95):
        assert told(ngram_join.join_classes(df, threshold=(least, 100)).collect()) == brute(rows, least)


def test_group_of_copies_that_are_near_each_other_but_not_their_leader(spark):
    """Copies a quarter away from their base, in two groups that are close: left to the blocks of tiles."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    rows, key = [(0, " ".join(base))], 1
    for group in range(12):
        first = [f"g{group}x{i}" if i % 12 == group % 3 else w for i, w in enumerate(base)]
        for _ in range(5):
            text = list(first)
            text[rng.randrange(200)] = f"own{key}"
            rows.append((key, " ".join(text)))
            key += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert told(ngram_join.join_classes(df).collect()) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join_classes(df).collect() == []


def test_linked_sets_share_a_tile():
    rng = np.random.default_rng(3)
    bands = ngram_join.Bands((90, 100))
    for n in (10, 11, 19, 20, 57, 300, 1000):
        for _ in range(60):
            shared = rng.integers(1, 2**63, n).astype(np.uint64)
            left, right = rng.integers(0, n // 9 + 1), rng.integers(0, n // 9 + 1)
            a = np.sort(np.concatenate([shared, rng.integers(1, 2**63, left).astype(np.uint64)]))
            b = np.sort(np.concatenate([shared, rng.integers(1, 2**63, right).astype(np.uint64)]))
            x, y = ngram_join.tiles([a, b], bands)
            x, y = set(x.tolist()), set(y.tolist())
            told = 100 * n >= 90 * (n + left + right)
            assert ngram_join.linked(a, b, (90, 100)) == told
            if told and (left or right):
                assert x & y
            maps = ngram_join.folded([ngram_join.bitmap(a), ngram_join.bitmap(b)])
            apart = np.bitwise_count(maps[0] ^ maps[1]).sum()
            assert apart <= left + right
            if told:
                assert ngram_join.may_link(np.array([apart]), np.array([len(a)]), np.array([len(b)]), (90, 100))[0]


def test_long_text_is_one_set():
    text = " ".join(f"w{i}" for i in range(200_000))
    found = next(ngram_join.gram_sets(pa.array([text])))
    assert len(found) == 199_998 and len(NOT_SPACE) == 256
    assert len(ngram_join.tiles([found], ngram_join.Bands((90, 100)))[0]) > 20_000
