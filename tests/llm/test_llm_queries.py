"""The registered queries on the smallest data, beside their SQL where there is some."""

import __spark_entry__ as entry
import pytest
from compare import compare, connect

from changelake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_warc_derivatives": "page_id record_type refers_to block_digest source_payload_digest",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_decontamination": "doc_id contaminated items",
    "op4_jaccard_join": "doc_id n_shingles component_id",
    "op5_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op6_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op8_html_extraction": "page_id url text n_chars",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op11_recurrent_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op12_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], ORACLE[name], SF) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_a_row_for_each_input(spark, name):
    found = QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(found.columns)
    source = spark.read.parquet(f"{SF}/{'pages' if 'page_id' in found.columns else 'documents'}.parquet")
    assert found.count() == source.count() * (2 if name == "op1_warc_derivatives" else 1)
