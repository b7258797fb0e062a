"""The queries of this folder, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from plumbline.llm import bpe, decontam, embeddings, langid, pii, simhash, templates, tokencount, urlrules, warc


def queries() -> dict:
    return {
        "op1_warc_round_trip": warc.op1_warc_round_trip,
        "op2_simhash_components": simhash.op2_simhash_components,
        "op3_embedding_components": embeddings.op3_embedding_components,
        "op4_line_templates": templates.op4_line_templates,
        "op5_benchmark_leaks": decontam.op5_benchmark_leaks,
        "op6_url_rules": urlrules.op6_url_rules,
        "op7_bpe_round_trip": bpe.op7_bpe_round_trip,
        "op8_language_id": langid.op8_language_id,
        "op9_token_counts": tokencount.op9_token_counts,
        "op10_pii_surrogates": pii.op10_pii_surrogates,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_round_trip": warc.ORACLE, "op6_url_rules": urlrules.ORACLE}
