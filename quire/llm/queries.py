"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from quire.llm import (
    op1_mixing,
    op2_toxicity,
    op3_html,
    op4_packing,
    op5_simhash,
    op6_rans,
    op7_quality,
    op8_topk,
    op9_warc,
    op10_suffix,
    op11_importance,
    op12_chat,
    op13_divergence,
)

QUERIES = {
    "op1_mix_sources": op1_mixing.op1_mix_sources,
    "op2_toxicity": op2_toxicity.op2_toxicity,
    "op3_html_text": op3_html.op3_html_text,
    "op4_packing": op4_packing.op4_packing,
    "op5_simhash": op5_simhash.op5_simhash,
    "op6_rans": op6_rans.op6_rans,
    "op7_quality_rules": op7_quality.op7_quality_rules,
    "op8_topk": op8_topk.op8_topk,
    "op9_warc": op9_warc.op9_warc,
    "op10_suffix_dedup": op10_suffix.op10_suffix_dedup,
    "op11_importance": op11_importance.op11_importance,
    "op12_chat_format": op12_chat.op12_chat_format,
    "op13_divergence": op13_divergence.op13_divergence,
}

# The others need fingerprints, tokenizers, Newton's method or page parsing: tests hold them against brute force.
ORACLE = {
    "op7_quality_rules": op7_quality.ORACLE,
    "op8_topk": op8_topk.ORACLE,
    "op9_warc": op9_warc.ORACLE,
    "op11_importance": op11_importance.ORACLE,
    "op12_chat_format": op12_chat.ORACLE,
    "op13_divergence": op13_divergence.ORACLE,
}
