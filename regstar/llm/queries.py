"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from regstar.llm import (
    decontaminate, embedding_dedup, exact_dedup, hard_negatives, near_dedup, pii, quality, resampling, secrets, sentencepieces,
    substring_dedup, toxicity, warc)

QUERIES = {
    "op1_embedding_near_dedup": embedding_dedup.op1_embedding_near_dedup,
    "op2_sentencepiece": sentencepieces.op2_sentencepiece,
    "op3_secret_scans": secrets.op3_secret_scans,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_warc": warc.op5_warc,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_pii": pii.op8_pii,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "op9_near_items": decontaminate.op9_near_items,
    "op10_minhash_near_dedup": near_dedup.op10_minhash_near_dedup,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_importance_resampling": resampling.op12_importance_resampling,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES = {
    "op5_warc": warc.ORACLE_SQL,
    "op6_substring_dedup": substring_dedup.ORACLE_SQL,
    "op9_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op11_exact_dedup": exact_dedup.ORACLE_SQL,
    "op12_importance_resampling": resampling.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
