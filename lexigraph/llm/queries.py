"""The numbered queries and the SQL for those that SQL can express."""

from __future__ import annotations

from lexigraph.llm import bpe, conversations, divergence, lines, media, merkle, mixing, pii, quality, secrets, simhash, substrings, urls

QUERIES = {
    "op1_media_columns": media.op1_media_columns,
    "op2_quality": quality.op2_quality,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_merkle_fingerprint": merkle.op4_merkle_fingerprint,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_substring_dedup": substrings.op6_substring_dedup,
    "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_personal_data": pii.op9_personal_data,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_url_filter": urls.op11_url_filter,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}
ORACLE_SQL = {
    "op5_line_dedup": lines.ORACLE_SQL,
    "op10_mix_sources": mixing.ORACLE_SQL,
    "op11_url_filter": urls.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
}
