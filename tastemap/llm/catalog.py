"""Registered queries of this package and their SQL."""

from __future__ import annotations

from tastemap.llm import (chat, decontaminate, lm_scoring, merkle, minhash, packing, piecewise, quality, repair, secrets,
                          span_dedup, suffix_dedup, warc)

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_sentence_span_dedup": span_dedup.op2_sentence_span_dedup,
    "op3_chat_prefix_targets": chat.op3_chat_prefix_targets,
    "op4_lm_scoring": lm_scoring.op4_lm_scoring,
    "op5_suffix_array_dedup": suffix_dedup.op5_suffix_array_dedup,
    "op6_warc_round_trip": warc.op6_warc_round_trip,
    "op7_minhash_near_dedup": minhash.op7_minhash_near_dedup,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_order_preserving_packing": packing.op9_order_preserving_packing,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_piecewise_fingerprint": piecewise.op11_piecewise_fingerprint,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

ORACLES = {
    "op1_quality_rules": quality.ORACLE,
    "op2_sentence_span_dedup": span_dedup.ORACLE,
    "op3_chat_prefix_targets": chat.ORACLE,
    "op6_warc_round_trip": warc.ORACLE,
    "op10_benchmark_decontamination": decontaminate.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_conversation_repair": repair.ORACLE,
}
