"""The registered queries against their check SQL on the smallest tables, and the contracts of those without."""

import os

import duckdb
import pytest
from compare import compare

import __spark_entry__ as entry
from tidemark.llm.catalog import CHECKS, QUERIES

COLUMNS = {
    "op1_range_ans": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_circulant_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op3_cost_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_ngram_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"],
    "op5_itq_hamming": ["vec_id", "n_links", "component_id", "kept"],
    "op6_sentence_spans": ["doc_id", "text", "n_removed"],
    "op7_boosted_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_label_propagation": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9_hierarchical_mix": ["doc_id", "domain", "lang", "source", "n_tokens", "epoch"],
    "op10_url_filter": ["page_id", "host", "path", "rule", "verdict"],
}


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_entry_has_every_query():
    assert {"pipeline", *QUERIES} <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
    assert sorted(QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert df.columns == COLUMNS[name]
    if name in CHECKS:
        problem, _ = compare(df, con, CHECKS[name])
        assert not problem
    else:
        assert df.count() > 0


def test_pipeline(spark, sf):
    assert os.path.exists(f"{sf}/documents.parquet")
    assert entry.queries()["pipeline"](spark, sf).count() > 0
