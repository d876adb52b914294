import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import bpe
from ledgerlens.llm.queries import vocabulary_path

RNG = random.Random(3)
TEXTS = [
    "",
    "it's we'll 'twas ''s I'd've they're'S",
    "  two  spaces\n\nand\t tabs \n end  ",
    "<|endoftext|> a<|endoftext|><|endoftext|>  b",
    "aaaa" * 700,
    " " * 300 + "x",
    "naïve café 日本語 Ⅷ ½ ٣ é \U0001f600    x",
    *["".join(RNG.choice("ab the reaing \n\t's0123456789.,!?é漢") for _ in range(RNG.randint(0, 90))) for _ in range(400)],
    *["".join(chr(RNG.randint(33, 0x2FFF)) for _ in range(60)) for _ in range(100)],
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def test_ids_are_those_of_the_library(library):
    ids = bpe.automaton(vocabulary_path()).encode(TEXTS)
    for text, got in zip(TEXTS, ids):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_read_one_at_a_time_match_lockstep():
    auto = bpe.automaton(vocabulary_path())
    words = [w for t in TEXTS for w in bpe.split_words([t])[0]][:500]
    assert auto.encode_words(words) == [auto._encode_long(w) for w in words]


def test_a_token_string_is_accepted_only_if_it_is_the_encoding(library):
    auto = bpe.automaton(vocabulary_path())
    for word in ("therefore", "banana", "aaaa", "unhappiness"):
        ids = library.encode(word, add_special_tokens=False).ids
        pairs = np.array(list(zip(ids, ids[1:])), dtype=np.int64).reshape(-1, 2)
        assert auto.has_arc(pairs[:, 0], pairs[:, 1]).all()
        single = [library.token_to_id(c) for c in word]
        wrong = np.array(list(zip(single, single[1:])), dtype=np.int64)
        assert not auto.has_arc(wrong[:, 0], wrong[:, 1]).all()


def test_small_cache_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    auto = bpe.Automaton(vocabulary_path())
    for text in TEXTS[:20]:
        assert np.frombuffer(auto.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_columns_and_digests(spark, library):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS[:40])] + [(99, None, None, None), (1, TEXTS[1], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded long").repartition(3)
    back = bpe.decode(bpe.encode(df, vocabulary_path()), vocabulary_path()).collect()
    assert len(back) == len(rows)
    for row in back:
        assert row.decoded == (row.text or "")
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids
    digests = {r.doc_id: r for r in bpe.digest(df, vocabulary_path()).collect()}
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert digests[key].n_tokens == len(ids)
        assert digests[key].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[key].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digest(df, vocabulary_path()).collect() == []


def test_a_worker_does_not_hold_the_automaton_after_a_task(spark):
    """Workers run the tasks of later steps too: what tokens needed must not stand beside these."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string").repartition(4)
    assert bpe.digest(docs, vocabulary_path()).where("round_trip").count() == 40

    def held(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(bpe._compiled)] * batch.num_rows, pa.int64())], ["n"])

    probed = spark.range(0, 40, 1, 8).mapInArrow(held, "n long")
    assert {r["n"] for r in probed.collect()} == {0}
