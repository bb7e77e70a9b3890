"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tallyspark.llm import (
    bpe, chat, exact_dedup, filter_audit, hard_negatives, mixing, pii, quality, sharding, simhash, substring_dedup, toxicity, vp_trees,
)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_chat_rotation": chat.op2_chat_rotation,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_simhash": simhash.op4_simhash,
    "op5_quality_voting": quality.op5_quality_voting,
    "op6_vp_trees": vp_trees.op6_vp_trees,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_jump_sharding": sharding.op8_jump_sharding,
    "op9_bpe_chunks": bpe.op9_bpe_chunks,
    "op10_source_mix": mixing.op10_source_mix,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
ORACLE = {
    "op2_chat_rotation": chat.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op6_vp_trees": vp_trees.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_substring_dedup": substring_dedup.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
