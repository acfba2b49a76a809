"""Queries of this package and the DuckDB statements that give the same rows."""

from __future__ import annotations

from freshet.llm import decontam, langid, merkle, mixing, neardup, pqcode, quality, secrets, surrogates, tokencount, topk, toxicity, vecdup

QUERIES = {
    "op1_top_k": topk.query,
    "op2_surrogates": surrogates.query,
    "op3_near_duplicates": neardup.query,
    "op4_secrets": secrets.query,
    "op5_quality": quality.query,
    "op6_token_counts": tokencount.query,
    "op7_decontaminate": decontam.query,
    "op8_language_id": langid.query,
    "op9_mix_sources": mixing.query,
    "op10_toxicity": toxicity.query,
    "op11_merkle_manifest": merkle.query,
    "op12_embedding_duplicates": vecdup.query,
    "op13_vector_codes": pqcode.query,
}

ORACLE = {
    "op1_top_k": topk.ORACLE,
    "op3_near_duplicates": neardup.ORACLE,
    "op4_secrets": secrets.ORACLE,
    "op7_decontaminate": decontam.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_embedding_duplicates": vecdup.ORACLE,
    "op13_vector_codes": pqcode.ORACLE,
}
