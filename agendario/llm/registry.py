"""Queries of this subpackage and the DuckDB SQL that checks them."""

from __future__ import annotations

from . import bpe, chat, decontaminate, html_blocks, jaccard, lm_score, neighbours, packing, periodic, pu_quality, quality_rules, urlfilter, whitening

QUERIES = {
    "op1_html_extraction": html_blocks.op1_html_extraction,
    "op10_lm_scoring": lm_score.op10_lm_scoring,
    "op11_nearest_neighbours": neighbours.op11_nearest_neighbours,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
    "op2_url_filter": urlfilter.op2_url_filter,
    "op3_token_id_output": packing.op3_token_id_output,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_ngram_jaccard_join": jaccard.op7_ngram_jaccard_join,
    "op8_quality_classifier": pu_quality.op8_quality_classifier,
    "op9_chat_formatting": chat.op9_chat_formatting,
}

ORACLE_SQL = {
    "op2_url_filter": urlfilter.ORACLE_SQL,
    "op6_quality_rules": quality_rules.ORACLE_SQL,
    "op9_chat_formatting": chat.ORACLE_SQL,
}
