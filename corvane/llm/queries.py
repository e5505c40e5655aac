"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from corvane.llm import bpe, exact_dedup, html_text, language_id, near_dedup, packing, quality_classifier, quality_rules, sharding, suffix_dedup

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op3_sharding": sharding.op3_sharding,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op2_packing": packing.op2_packing,
    "op5_bpe": bpe.op5_bpe,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_html_text": html_text.op10_html_text,
}

ORACLES = {
    "op3_sharding": sharding.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
}
