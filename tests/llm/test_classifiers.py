import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import labelled, language, quality, toxicity

RNG = random.Random(4)
PLAIN, BAD = [f"plain{i}" for i in range(300)], ["nasty", "vile", "rotten"]


def _text(toxic=False, n=60):
    words = [RNG.choice(PLAIN) for _ in range(n)]
    if toxic:
        for _ in range(3):
            words[RNG.randrange(n)] = RNG.choice(BAD)
    return " ".join(words)


def _auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    return np.mean([(scores[labels == 1] > s).mean() + 0.5 * (scores[labels == 1] == s).mean() for s in scores[labels == 0]])


def _tables(spark, rows):
    docs = spark.createDataFrame([(k, t, "c", 1, 0.5) for k, t, _ in rows], "doc_id long, text string, label string, order int, score double")
    labels = spark.createDataFrame([(k, y, None) for k, _, y in rows], "doc_id long, toxic int, sample_key string")
    return docs.repartition(3), labels


ODD = [(-1, None, 0), (-2, "", 0), (-3, "x", None), (None, "y z", 1), (-4, "z " * 100_000, 0)]


def test_toxicity_on_rows_that_were_not_learned(spark):
    rows = [(i, _text(i % 5 == 0), int(i % 5 == 0)) for i in range(1500)] + ODD + [(7, _text(), 0)]
    docs, labels = _tables(spark, rows)
    held = F.coalesce(labelled.remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = toxicity.fit(docs, labels, "toxic", ~held)
    assert 0 < len(model["index"]) < 5_000  # most weights are exactly zero
    found = toxicity.score(docs, model).withColumnRenamed("key", "doc_id").withColumn("held", held).collect()
    assert len(found) == len(rows)
    tested = [(r.score, int(r.doc_id % 5 == 0)) for r in found if r.held and r.doc_id >= 0]
    assert len(tested) > 200 and _auc(*zip(*tested)) > 0.98
    assert all(0 <= r.score <= 1 for r in found)
    by_key = {r.doc_id: r.score for r in found}
    assert by_key[-1] == by_key[-2]


def test_toxic_words_of_three_rows_are_learned(spark):
    rows = [(i, _text(), 0) for i in range(300)] + [(i, _text() + " seldom", 1) for i in (300, 301, 302)]
    docs, labels = _tables(spark, rows)
    model = toxicity.fit(docs, labels, "toxic", F.lit(True))
    index = int(toxicity.features(pa.array(["seldom"]))[1][0])
    weight = dict(zip(model["index"].tolist(), model["weight"].tolist()))
    assert weight.get(index, 0.0) > 1.3


def test_features_count_once_and_stay_in_their_text():
    row, index = toxicity.features(pa.array(["a b c", "a b", None, ""]))
    assert np.bincount(row, minlength=4).tolist() == [3 + 2 + 1, 2 + 1, 0, 0]
    first = {i for r, i in zip(row, index) if r == 0}
    assert {i for r, i in zip(row, index) if r == 1} <= first


def test_factorisation_machine_uses_all_pairs():
    rng = np.random.default_rng(2)
    wide = len(quality.STATISTICS)
    state = quality.start_state(np.zeros(wide), np.ones(wide))
    for name in ("w", "v", "wd", "vd"):
        state[name] = rng.normal(0, 0.3, state[name].shape).astype(np.float32)
    dense = rng.normal(0, 1, (2, wide)).astype(np.float32)
    row, index = np.array([0, 0, 0, 1]), np.array([5, 9, 11, 9])
    found = quality._forward(state, row, index, dense, 2)[0]
    for i in range(2):
        at = index[row == i]
        x = np.concatenate([dense[i], np.full(len(at), 1 / np.sqrt(len(at)))])
        w = np.concatenate([state["wd"], state["w"][at]])
        v = np.concatenate([state["vd"], state["v"][at]])
        pairs = sum(v[a] @ v[b] * x[a] * x[b] for a in range(len(x)) for b in range(a))
        assert found[i] == pytest.approx(state["w0"][0] + w @ x + pairs, rel=1e-3)


def test_quality_on_rows_that_were_not_learned(spark):
    def junk(i):
        return RNG.choice([_text().upper() + "!!", "*** ".join(_text().split()), "same same " * 50, " | ".join(_text().split())])

    rows = [(i, junk(i) if i % 4 == 0 else _text(n=RNG.randint(5, 200)), int(i % 4 != 0)) for i in range(1200)] + ODD
    docs, labels = _tables(spark, rows)
    docs = docs.withColumn("n_chars", F.length("text"))
    held = F.coalesce(labelled.remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.fit(docs, labels.withColumnRenamed("toxic", "quality"), "quality", ~held)
    found = quality.score(docs, model).withColumnRenamed("key", "doc_id").withColumn("held", held).collect()
    assert len(found) == len(rows)
    tested = [(r.score, int(r.doc_id % 4 != 0)) for r in found if r.held and r.doc_id >= 0]
    assert len(tested) > 150 and _auc(*zip(*tested)) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


LANGUAGES = {"aa": "ka ki ku", "bb": "schn pft ung", "cc": "é ção ñe"}


def _said(name, n=40):
    parts = LANGUAGES[name].split()
    return " ".join("".join(RNG.choice(parts) for _ in range(RNG.randint(1, 3))) for _ in range(n))


def test_language_on_rows_that_were_not_learned(spark):
    names = list(LANGUAGES)
    rows = [(i, _said(names[i % 3], RNG.choice([2, 10, 400])), names[i % 3]) for i in range(400)]
    rows += [(-1, None, "aa"), (-2, "", "bb"), (-3, "12 ... !?", "aa"), (-4, _said("bb"), None), (None, _said("cc"), "cc"), (5, _said("aa"), "aa")]
    docs = spark.createDataFrame([(k, t, n, 1) for k, t, n in rows], "doc_id long, text string, lang string, order int").repartition(3)
    held = F.coalesce(labelled.remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.fit(docs, "lang", ~held)
    assert model["languages"] == names
    found = language.predict(docs, model).withColumnRenamed("key", "doc_id").withColumn("held", held).collect()
    assert len(found) == len(rows)
    tested = [r.language == names[r.doc_id % 3] for r in found if r.held and r.doc_id >= 0]
    assert len(tested) > 50 and np.mean(tested) > 0.97
    told = {r.doc_id: r.language for r in found}
    assert told[-1] == told[-2] == told[-3] == "und" and told[-4] == "bb" and told[None] == "cc"
    assert all(0 <= r.score <= 1 for r in found)


def test_without_labels(spark):
    docs, labels = _tables(spark, [(1, "some words", 1), (2, None, 0)])
    none = F.lit(False)
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, labels, "toxic", none)).collect()] == [0.5, 0.5]
    good = quality.score(docs, quality.fit(docs, labels, "toxic", none)).collect()
    assert all(abs(r.score - 0.5) < 0.1 for r in good)
    found = language.predict(docs, language.fit(docs, "label", none)).collect()
    assert {(r.language, r.score) for r in found} == {("und", 0.0)}
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, labels, "toxic", ~none)).collect() == []
    assert quality.score(empty, quality.fit(empty, labels, "toxic", ~none)).collect() == []


def test_sample_is_bounded_and_stable(spark):
    _, labels = _tables(spark, [(i, "", i % 2) for i in range(500)] + [(3, "", 0), (None, "", 1)])
    one = labelled.sample(labels, "toxic", F.col("doc_id") > 9, "doc_id", 100).collect()
    two = labelled.sample(labels.repartition(7), "toxic", F.col("doc_id") > 9, "doc_id", 100).collect()
    assert len(one) == 100 and sorted(one) == sorted(two) and min(r.sample_key for r in one) > 9


def test_update_equals_a_plain_loop():
    """FTRL-proximal coordinate by coordinate, over the rows in the order that the seed gives."""
    rng = np.random.default_rng(3)
    size, rows = 40, [np.unique(rng.integers(0, 40, 9)) for _ in range(60)]
    label = (rng.random(60) < 0.3).astype(np.float32)
    batch = pa.RecordBatch.from_pydict(
        {
            "label": pa.array([label.tolist()], pa.list_(pa.float32())),
            "ends": pa.array([np.cumsum([len(r) for r in rows]).tolist()], pa.list_(pa.int64())),
            "index": pa.array([np.concatenate(rows).tolist()], pa.list_(pa.int32())),
            "dense": pa.array([[]], pa.list_(pa.float32())),
        }
    )
    state = {name: np.zeros(size + 1, dtype=np.float32) for name in ("z", "n")}
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)
    for number in (0, 1):
        state = toxicity._train(labelled.Shard(batch, 0), state, number)
        for i in np.random.default_rng(number).permutation(60).tolist():
            w = {}
            for j in [*rows[i].tolist(), size]:
                rate = (toxicity.BETA + n[j] ** 0.5) / toxicity.ALPHA + (0 if j == size else toxicity.L2)
                shrink = 0.0 if j == size else toxicity.L1
                w[j] = 0.0 if abs(z[j]) <= shrink else -(z[j] - (shrink if z[j] > 0 else -shrink)) / rate
            g = 1 / (1 + np.exp(-sum(w.values()))) - float(label[i])
            for j, weight in w.items():
                z[j] += g - ((n[j] + g * g) ** 0.5 - n[j] ** 0.5) / toxicity.ALPHA * weight
                n[j] += g * g
        z, n = [float(np.float32(v)) for v in z], [float(np.float32(v)) for v in n]
    assert state["z"] == pytest.approx(np.array(z), abs=1e-4) and state["n"] == pytest.approx(np.array(n), abs=1e-4)


def test_every_frequent_feature_is_kept(spark):
    rows = [(i, 0.0, [i % 7, 100 + i, (1 << toxicity.BITS) - 1], []) for i in range(30)]
    made = spark.createDataFrame(rows, labelled.ROWS).repartition(3)
    last = (1 << toxicity.BITS) - 1
    assert toxicity._numbers(toxicity._frequent(made, 2)).tolist() == [*range(7), last]
    assert toxicity._numbers(toxicity._frequent(made, 1)).tolist() == [*range(7), *range(100, 130), last]
    assert toxicity._numbers(toxicity._frequent(made.limit(0), 1)).tolist() == []


def test_rare_language_is_learned(spark, monkeypatch):
    """Three rows in 3,000 of a language, and a sample of 90 rows."""
    monkeypatch.setattr(language, "TRAINING_ROWS", 90)
    rng = random.Random(1)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30))
    rows = [(i, text("abcdefg"), "aa") for i in range(2000)] + [(i, text("ghijklm"), "bb") for i in range(2000, 2997)]
    rows += [(i, text("nopqrst"), "cc") for i in range(2997, 3000)] + [(5000, text("nopqrst"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.fit(df, "lang", F.lit(True))
    assert model["languages"] == ["aa", "bb", "cc"]
    found = {r.key: r.language for r in language.predict(df, model).collect()}
    assert found[5000] == "cc" and sum(found[k] == lang for k, _, lang in rows if lang) > 2_980


def test_ridge_equals_a_dense_solve_over_set_arithmetic(spark):
    """Kernel values from sets of hashed n-grams, regressions with every row in memory."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["un deux", "eins zwei", "one two", "tre"]) for _ in range(6)), ["x", "y"][i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, "lang", F.lit(True))
    texts = pa.array([t for _, t, _ in rows])
    sets = [set(np.flatnonzero(p).tolist()) for p in language.presence(texts)]
    marks = [set(np.flatnonzero(p).tolist()) for p in model["landmarks"]]
    k = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    cross = np.array([[k(a, b) for b in marks] for a in sets])
    assert language.kernel(texts, model["landmarks"]) == pytest.approx(cross, abs=1e-5)
    between = np.array([[k(a, b) for b in marks] for a in marks])
    target = np.array([[1.0 if lang == name else -1.0 for name in model["languages"]] for _, _, lang in rows])
    m = len(marks)
    want = np.linalg.solve(cross.T @ cross + language.RIDGE * len(rows) / m * between + 1e-6 * np.eye(m), cross.T @ target)
    assert cross @ model["weights"] == pytest.approx(cross @ want, abs=2e-3)


def test_a_shard_gives_only_the_bits_that_it_changed():
    before = np.random.default_rng(3).normal(size=(400, 100)).astype(np.float32)
    now = before.copy()
    now[7] *= 1.5
    told = labelled.changes(now, before)
    assert len(zlib.compress(told.tobytes(), 1)) < before.nbytes / 100
    assert np.array_equal((before.ravel().view(np.uint32) ^ told).view(np.float32), now.ravel())
