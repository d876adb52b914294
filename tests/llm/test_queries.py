"""The registered queries over whole test tables: against SQL, or against a brute-force version."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from ledgerlens.llm import queries, stages
from ledgerlens.session import materialize
from test_decontaminate import brute as brute_contamination
from test_near_dup import classes

CONTRACT = {
    "op1_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op3_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated n_near",
    "op4_toxicity": "doc_id held_out score predicted",
    "op5_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_near_dedup": "doc_id n_shingles component_id kept",
    "op7_pii": "doc_id n_entities entities text",
    "op8_language": "doc_id held_out lang_pred score",
    "op9_quality": "doc_id held_out score predicted",
    "op10_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op11_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_ngram_join": "doc_id n_shingles component_id",
}


def _duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("key", list(queries.all_oracles()))
def test_query_matches_sql(spark, sf_check, key):
    found = queries.all_queries()[key](spark, sf_check)
    expected = _duck(sf_check).sql(queries.all_oracles()[key])
    at = [expected.columns.index(c) for c in found.columns]
    want = sorted(repr(tuple(row[i] for i in at)) for row in expected.fetchall())
    assert sorted(repr(tuple(r)) for r in found.collect()) == want


@pytest.mark.parametrize("key", [k for k in queries.all_queries() if k not in queries.all_oracles()])
def test_query_gives_its_columns_and_every_row(spark, sf_small, key):
    found = queries.all_queries()[key](spark, sf_small)
    wanted = CONTRACT[key].split()
    assert found.columns[: len(wanted)] == wanted
    documents = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(r.doc_id for r in documents.collect())


def test_pipeline_stage_by_stage(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    pairs = lambda df: {r.doc_id: r.text for r in df.collect()}
    kept = materialize(stages.quality(spark, docs, sf_small), "test")
    assert kept.columns == docs.columns
    good = {r.doc_id for r in queries.op9_quality(spark, sf_small).collect() if r.predicted}
    assert set(pairs(kept)) == good
    before = pairs(kept)
    kept = materialize(stages.exact_dedup(spark, kept, sf_small), "test")
    latest = {}
    for key, text in before.items():
        latest[text or ""] = max(key, latest.get(text or "", key))
    assert set(pairs(kept)) == set(latest.values())
    before = pairs(kept)
    kept = materialize(stages.near_dedup(spark, kept, sf_small), "test")
    assert set(pairs(kept)) == {k for k, (_, c) in classes(list(before.items()), 80).items() if k == c}
    before = pairs(kept)
    kept = materialize(stages.decontaminate_docs(spark, kept, sf_small), "test")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert set(pairs(kept)) == {k for k, _, _, _, bad in brute_contamination(list(before.items()), items) if not bad}
    assert kept.columns == docs.columns
    last = stages.tokens(spark, kept, sf_small).collect()
    assert {r.doc_id for r in last} == set(pairs(kept)) and all(r.round_trip for r in last)
    assert all(len(r.ids) == r.n_tokens for r in last)
    whole = corpus_pipeline.run(spark, sf_small).collect()
    assert sorted(whole) == sorted(last)


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_pipeline_with_an_empty_table(spark, sf_small, tmp_path, empty):
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{sf_small}/{name}.parquet")
        (table.limit(0) if name == empty else table.limit(40)).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert (found == []) == (empty == "documents") and all(r.round_trip for r in found)
