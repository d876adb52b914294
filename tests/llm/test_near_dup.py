import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import near_dup, queries, stages
from ledgerlens.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes(rows, least=85):
    """Brute force: {key: (set size, least key reachable)}; links from a similarity of ``least`` per cent."""
    sets = [(k, shingles(t)) for k, t in rows]
    parent = {k: k for k, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if sa and sb and 100 * len(sa & sb) >= least * len(sa | sb):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {k: (len(s), find(k)) for k, s in sets}


def _rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (7, "É b c d e"), (8, "é b c d e")]
    key = 10
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 40, 150, 400]))]
        for edits in (0, 0, 1, 2, 3, 5, 8, 14):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((key, " ".join(words)))
            key += 1
    # a chain: every text is near the next, the ends are far apart
    chain = [rng.choice(vocabulary) for _ in range(200)]
    for step in range(30):
        chain[step * 6] = f"changed{step}"
        rows.append((key, " ".join(chain)))
        key += 1
    rng.shuffle(rows)
    return rows


def test_classes_match_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, row int, class string").repartition(4)
    expected = classes(rows)
    found = near_dup.near_classes(df).collect()
    assert {r.key: (r.n_shingles, r.component_key) for r in found} == expected
    assert {r.key for r in found if r.kept} == {k for k, (_, c) in expected.items() if k == c}


def test_stage_links_from_four_fifths_and_op6_from_its_own_figure(spark, tmp_path):
    """One changed word in the middle of n words leaves (n - 9) of (n + 1) shingles: 50 words are at 0.80, 59 at 0.83."""
    rows, key = [], 0
    for n in (48, 49, 50, 54, 59, 66, 70):
        words = [f"n{n}w{i}" for i in range(n)]
        for middle in (words[n // 2], "other"):
            rows.append((key, " ".join([*words[: n // 2], middle, *words[n // 2 + 1 :]])))
            key += 1
    sets = {k: shingles(t) for k, t in rows}
    alike = {k: len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, key, 2)}
    assert sum(0.8 <= x < 0.85 for x in alike.values()) >= 3 and min(alike.values()) < 0.8 and max(alike.values()) >= 0.85
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = lambda least: {k for k, _ in rows if k % 2 == 0 or alike[k - 1] < least}
    assert {r.doc_id for r in stages.near_dedup(spark, df, "").collect()} == kept(0.8)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in queries.op6_near_dedup(spark, str(tmp_path)).collect() if r.kept} == kept(0.85)


def test_rows_that_stay(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (9, None), (9, None), (8, "x y")]
    df = spark.createDataFrame([(k, t, "e") for k, t in rows], "doc_id long, text string, kept string")
    out = near_dup.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(3, "a b c d e f"), (8, "x y"), (9, "")]
    assert near_dup.near_classes(df.limit(0)).collect() == []


def test_bucket_of_unlinked_classes_is_resolved(spark, monkeypatch):
    """With one register for a band, most classes meet in every bucket: the last step decides what the leads left."""
    monkeypatch.setattr(near_dup, "bands", lambda sketch: np.tile(np.arange(near_dup.BANDS, dtype=np.uint64), (len(sketch), 1)))
    rows = [r for r in _rows() if r[0] < 60]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = near_dup.near_classes(df).collect()
    assert {r.key: (r.n_shingles, r.component_key) for r in found} == classes(rows)


def test_registers_are_mergeable_and_follow_the_similarity():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, (2, 3000)).astype(np.uint64)
    shared = rng.integers(0, 2**63, 9000).astype(np.uint64)
    sa, sb = np.concatenate([a, shared]), np.concatenate([b, shared])
    ra, rb, union = near_dup.registers([sa, sb, np.concatenate([sa, sb])])
    assert (np.maximum(ra, rb) == union).all()
    likely = near_dup.likely_similarity(ra[None], rb[None], np.array([12000.0]), np.array([12000.0]))
    assert likely[0] == pytest.approx(9 / 15, abs=0.15)


def test_long_text_is_one_set():
    text = " ".join(f"w{i}" for i in range(200_000))
    assert len(next(near_dup.shingle_sets(pa.array([text])))) == 199_996


def test_components_of_a_path_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(9, 9), (3, 2), (2, 3)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)} | {9: 9, 2: 2, 3: 2}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_class_with_many_partners_is_copied(spark, monkeypatch):
    """Near copies of one text: every pair leads back to it, in parts of two partners."""
    monkeypatch.setattr(near_dup, "PARTNERS", 2)
    rows = [r for r in _rows() if r[0] < 200]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_dup.near_classes(df).collect()
    assert {r.key: (r.n_shingles, r.component_key) for r in found} == classes(rows)
    pairs = spark.createDataFrame([(1, b) for b in range(2, 12)] + [(2, 3)], "a long, b long")
    parts = near_dup._parted(pairs).groupBy("a", "part").count().collect()
    assert len({r.part for r in parts if r.a == 1}) > 1 and {r.part for r in parts if r.a == 2} == {0}


def test_only_buckets_of_several_classes_are_placed(spark):
    """A bucket of one class never links anything: its rows are left before components are looked up."""
    sketch = spark.createDataFrame([(1, [10, 20, 30]), (2, [10, 21, 31]), (3, [11, 22, 31])], "class bigint, bands array<bigint>")
    found = {(r.band, r.bucket, r["class"]) for r in near_dup._shared_rows(sketch).collect()}
    assert found == {(0, 10, 1), (0, 10, 2), (2, 31, 2), (2, 31, 3)}


def test_texts_and_sketches_go_in_small_batches(spark, monkeypatch):
    """A batch of 10,000 texts stands in the JVM and in the worker at once; the session's setting comes back after."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, store = spark.conf.get(setting), [], near_dup.materialize

    def watched(df, label):
        seen.append((label, int(spark.conf.get(setting))))
        return store(df, label)

    monkeypatch.setattr(near_dup, "materialize", watched)
    docs = spark.createDataFrame(_rows(), "doc_id long, text string")
    assert near_dup.near_classes(docs).count() == len(_rows())
    sizes = dict(seen)
    assert {"sketches", "shingle-sets", "plausible-pairs"} <= sizes.keys()
    assert max(sizes[k] for k in ("sketches", "shingle-sets", "plausible-pairs")) <= near_dup.BATCH_ROWS < 10_000
    assert spark.conf.get(setting) == before
