"""The registered queries: those with SQL equal it, all run on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import canon, duck

import __spark_entry__ as E
from rosterframe.llm.registry import ORACLE, QUERIES

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

COLUMNS = {
    "op2_simhash_dedup": ["doc_id", "fingerprint", "component_id"],
    "op4_html_main_text": ["page_id", "url", "text", "n_chars"],
    "op5_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op8_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op12_rendezvous_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op13_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op9_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


def test_entry_lists_them():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in E.queries()) == 1
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_runs(spark, key):
    df = QUERIES[key](spark, SF001)
    rows = df.collect()
    assert rows
    if key in COLUMNS:
        assert df.columns[: len(COLUMNS[key])] == COLUMNS[key]
    if key.split("_")[0] in ("op2", "op5", "op6", "op8", "op1"):
        assert len(rows) == spark.read.parquet(f"{SF001}/documents.parquet").count()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_against_sql(spark, key):
    df = QUERIES[key](spark, SF01)
    cur = duck(SF01).execute(ORACLE[key])
    want = canon([x[0] for x in cur.description], cur.fetchall())
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == want
