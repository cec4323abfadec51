"""Queries of this subpackage, by name."""

from __future__ import annotations

from minewright.llm import collocations, hard_negatives, language_id, ngram_join, packing, pieces, suffix_dedup, token_counts, topk, toxicity, url_rules, vector_dedup, warc

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_topk_search": topk.op2_topk_search,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_vector_dedup": vector_dedup.op4_vector_dedup,
    "op5_url_filters": url_rules.op5_url_filters,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_language_id": language_id.op9_language_id,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_phrase_collocations": collocations.op11_phrase_collocations,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_warc": warc.op13_warc,
}
ORACLES = {
    "op2_topk_search": topk.OP2_SQL,
    "op4_vector_dedup": vector_dedup.OP4_SQL,
    "op5_url_filters": url_rules.OP5_SQL,
    "op10_ngram_join": ngram_join.OP10_SQL,
    "op11_phrase_collocations": collocations.OP11_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_warc": warc.OP13_SQL,
}
