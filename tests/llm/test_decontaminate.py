import random
import re

from ledgerlens.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        windows += [(str(item), w[i : i + n]) for i in range(len(w) - n + 1)] if n else []
    out = []
    for key, text in docs:
        w = words(text)
        hit, told = set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    told.add(item)
        out.append((key, len(w), len(hit), sorted(told), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def _case():
    rng = random.Random(5)
    vocabulary = ["the", "of"] * 20 + [f"w{i}" for i in range(60)] + ["é", "Ünder"]
    sentence = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(sentence(rng.choice([1, 2, 5, 12, 13, 14, 30, 60])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "..."), (103, "the"), (104, items[0][1]), (105, "a a a a a a a a a a a a a a")]
    docs = [(1, None), (2, ""), (3, "- -"), (4, "a " * 40), (5, "The OF the"), (5, "The OF the"), (None, items[3][1])]
    for i in range(60):
        text = sentence(rng.choice([0, 5, 100, 600]))
        for _ in range(rng.choice([0, 1, 3])):
            part = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, len(text))
            text[at:at] = part[: rng.randint(0, len(part))] if rng.random() < 0.5 else part
        docs.append((10 + i, rng.choice([" ", ", ", "\n"]).join(text).upper() if i % 3 else " ".join(text)))
    docs.append((900, " ".join(sentence(20_000) + (items[6][1] or "").split())))
    return docs, items


def _frames(spark, docs, items):
    df = spark.createDataFrame([(k, t, 0, "c") for k, t in docs], "doc_id long, text string, shard int, item string")
    return df.repartition(3), spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc int")


def _found(result):
    rows = result.collect()
    assert all(r.n_items == len(r["items"]) and r.n_near >= r.n_items for r in rows)
    return sorted(((r.key, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows), key=repr)


def test_matches_brute_force(spark):
    docs, items = _case()
    assert _found(decontaminate.contamination(*_frames(spark, docs, items))) == brute(docs, items)


def test_small_blocks_shards_and_a_full_index_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 150)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 2000)
    monkeypatch.setattr(decontaminate, "TERM_LIMIT", 3)
    docs, items = _case()
    assert _found(decontaminate.contamination(*_frames(spark, docs, items))) == brute(docs, items)


def test_proximity_matches_allow_other_orders(spark):
    item = "alpha beta gamma delta epsilon"
    docs = [(1, "epsilon delta x x gamma beta alpha"), (2, "alpha beta " + "x " * 60 + "gamma delta epsilon"), (3, item)]
    found = decontaminate.contamination(*_frames(spark, docs, [(1, item)])).collect()
    assert sorted((r.key, r.n_near, r.n_items) for r in found) == [(1, 1, 0), (2, 0, 0), (3, 1, 1)]


def test_empty_tables_and_rows_that_stay(spark):
    docs, items = _case()
    df, benchmark = _frames(spark, docs, items)
    assert decontaminate.contamination(df.limit(0), benchmark).collect() == []
    assert {r.contaminated for r in decontaminate.contamination(df, benchmark.limit(0)).collect()} == {False}
    out = decontaminate.drop_contaminated(df, benchmark)
    assert out.columns == df.columns
    kept = sorted((r.doc_id, len(words(r.text))) for r in out.collect() if r.doc_id is not None)
    assert kept == sorted((k, n) for k, n, _, _, bad in brute(docs, items) if not bad and k is not None)


def brute_near(docs, items):
    """{document number: items with a place of a window's rarest word that has all its other words within 26 words}."""
    texts = [words(t) for _, t in docs]
    wanted = {w for _, t in items for w in words(t)}
    counts = {}
    for text in texts:
        for w in text:
            if w in wanted:
                counts[w] = counts.get(w, 0) + 1
    out = {i: set() for i in range(len(docs))}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            window = set(w[at : at + n])
            if not all(x in counts for x in window):
                continue
            rarest = min(window, key=lambda x: (counts[x], x.encode()))
            for i, doc in enumerate(texts):
                for p, x in enumerate(doc):
                    if x == rarest and window <= set(doc[max(0, p - 26) : p + 27]):
                        out[i].add(item)
                        break
    return {i: len(v) for i, v in out.items()}


def test_proximity_matches_equal_brute_force(spark):
    docs, items = _case()
    docs = [(i, t) for i, (_, t) in enumerate(docs) if i < 60]
    df, wanted = _frames(spark, docs, items)
    found = {r.key: r.n_near for r in decontaminate.contamination(df, wanted).collect()}
    assert found == brute_near(docs, items) and max(found.values()) > 3
