"""Contract columns come first, in the stated order; more columns follow them."""

import pytest

from pageloom.llm import queries

COLUMNS = {
    "op1_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op2_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op5_quality_gam": ["doc_id", "held_out", "score", "predicted"],
    "op6_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_recurrent_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11_ranked_search": ["item_id", "rank", "doc_id", "score"],
    "op12_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op13_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, sf, name):
    want = COLUMNS[name]
    assert queries.QUERIES[name](spark, sf).columns[: len(want)] == want
