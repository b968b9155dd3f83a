"""The registered queries against their SQL, and their results' columns."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL
from farelake.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings labels benchmark".split()

COLUMNS = {
    "op1_piece_dropout": "doc_id n_ids ids lossless",
    "op2_licences": "doc_id sentences licences",
    "op3_minhash": "doc_id n_shingles component_id kept",
    "op4_vectors": "vec_id n_links component_id kept",
    "op5_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_compression": "doc_id held_out score predicted",
    "op8_substrings": "doc_id n_words n_removed kept_sha256",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op10_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op13_ranked_search": "item_id rank doc_id score",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, SMALL)
    assert frame.columns == COLUMNS[name].split()
    rows = [tuple(r) for r in frame.collect()]
    table = "embeddings" if name == "op4_vectors" else "documents"
    if name not in ("op6_packing", "op13_ranked_search"):
        assert len(rows) == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    if name in ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
        result = con.execute(ORACLES[name])
        assert [d[0] for d in result.description] == frame.columns
        assert sorted(rows) == sorted(result.fetchall())
