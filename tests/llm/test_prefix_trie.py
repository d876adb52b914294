import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import prefix_trie, queries

COLUMNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        whole = own.get(base, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    words = lambda t: len([w for w in "".join(" " if x in "\t\n\x0b\x0c\r" else x for x in t).split(" ") if w])
    out = {}
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaf = lambda n: not any(m[: len(n)] == n and len(m) > len(n) for m in members)
        saved = sum((len(members[n]) - 1) * words(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c, last in who if last))
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        key = (min(c for c, _ in who), len(node))
        assert key not in out
        out[key] = (parent, len(who), len(children), sum(map(leaf, below)), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def run(spark, rows, folder):
    spark.createDataFrame([(*r, 1) for r in rows], f"{COLUMNS}, depth int").write.parquet(f"{folder}/conversations.parquet")
    found = queries.op12_prefix_trie(spark, str(folder)).collect()
    assert len({(r.conv_id, r.depth) for r in found}) == len(found)
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in found}


def random_rows():
    rng = random.Random(4)
    rows = []
    for conv in [*range(90), -7, -40]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a b", "c\td\n e", "", None])))
    return rows


@pytest.mark.parametrize("chunk", [2, 256])
def test_nodes_match_a_plain_trie(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "PATH_BLOCK", chunk)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = random_rows() + [(None, 0, "user", "no conversation"), (200, None, None, "x"), (200, None, None, "x"), (201, 5, "user", "y")]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_long_and_equal_conversations(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 8)
    monkeypatch.setattr(prefix_trie, "PATH_BLOCK", 10)
    rows = [(20, i, "user", f"t{i}") for i in range(60)] + [(c, i, "user", "same") for c in range(300, 340) for i in range(3)]
    rows += [(21, i, "user", f"t{i}") for i in range(50)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == {}


def test_products_compose():
    r = prefix_trie.base_of(0)
    turns = [prefix_trie.element(hashlib.md5(bytes([i])).hexdigest()) for i in range(9)]

    def whole(part):
        out = (0, 0)
        for t in part:
            out = prefix_trie.product(out, (1, t), r)
        return out

    for i in range(10):
        head, tail = whole(turns[:i]), whole(turns[i:])
        assert prefix_trie.product(head, tail, r) == whole(turns)
        assert prefix_trie.suffix(whole(turns), head, r) == tail


def test_colliding_fingerprints_are_noticed(spark, monkeypatch):
    """With a base of zero only the last turn counts: every attempt finds unsound nodes."""
    monkeypatch.setattr(prefix_trie, "base_of", lambda seed: prefix_trie.P + 1 if seed < 1 else 3 + seed)
    rows = [(c, i, "user", f"{(c + i) % 2}") for c in range(8) for i in range(4)]
    df = spark.createDataFrame(rows, COLUMNS)
    found = prefix_trie.trie(df, F.col("conv_id"), F.lit(0))
    assert found.where("depth = 0").first().n_convs == 8 and found.count() == 9
    monkeypatch.setattr(prefix_trie, "base_of", lambda seed: prefix_trie.P + 1)
    rows = [(0, 0, "user", "a"), (0, 1, "user", "b"), (1, 0, "user", "b"), (1, 1, "user", "a")]
    with pytest.raises(RuntimeError):
        prefix_trie.trie(spark.createDataFrame(rows, COLUMNS), F.col("conv_id"), F.lit(0))
