"""Queries and SQL of this subpackage's operators, by name."""

from __future__ import annotations

from . import chat, exact_dedup, language_id, licenses, near_dup, nearest, packing, pieces, pii, pii_rules, shards

QUERIES = {
    "op1_language_id": language_id.query,
    "op2_minhash_near_dedup": near_dup.query,
    "op3_license_scan": licenses.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_best_fit_packing": packing.query,
    "op6_sentencepiece": pieces.query,
    "op7_pii": pii.query,
    "op8_sharding": shards.query,
    "op9_chat_formatting": chat.query,
    "op10_nearest": nearest.query,
}
ORACLE_SQL = {
    "op2_minhash_near_dedup": near_dup.SQL,
    "op3_license_scan": licenses.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op7_pii": pii_rules.SQL,
    "op8_sharding": shards.SQL,
    "op9_chat_formatting": chat.SQL,
    "op10_nearest": nearest.SQL,
}
