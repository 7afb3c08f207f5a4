"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from foldlake.llm import chat, decontaminate, html_text, jaccard_join, lm_scoring, mixing_rates, oracles, quality, repeats, secrets, spelling, token_records, warc

QUERIES = {
    "op1_html_text": html_text.op1_html_text,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_token_records": token_records.op3_token_records,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_warc_segments": warc.op6_warc_segments,
    "op7_chat_format": chat.op7_chat_format,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_mixing_rates": mixing_rates.op10_mixing_rates,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_repeat_removal": repeats.op12_repeat_removal,
}

ORACLE_SQL: dict[str, str] = oracles.ORACLE_SQL
