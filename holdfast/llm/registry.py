"""Queries of this subpackage: name -> callable, and SQL where it can express them."""

from __future__ import annotations

from holdfast.llm import (conversation_repair, hamming_index, line_dedup, line_rules, ngram_join, packing, pii, spelling,
                          templates, token_counts, tool_calls, toxicity, url_rules)

QUERIES = {
    "op1_tool_call_linking": tool_calls.op1_tool_call_linking,
    "op2_line_rules": line_rules.op2_line_rules,
    "op3_pii_spans": pii.op3_pii_spans,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_url_rules": url_rules.op5_url_rules,
    "op6_toxicity_cnn": toxicity.op6_toxicity_cnn,
    "op7_template_decontamination": templates.op7_template_decontamination,
    "op8_ngram_jaccard_join": ngram_join.op8_ngram_jaccard_join,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_multi_index_hashing": hamming_index.op12_multi_index_hashing,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLES = {
    "op1_tool_call_linking": tool_calls.SQL,
    "op2_line_rules": line_rules.SQL,
    "op7_template_decontamination": templates.SQL,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
