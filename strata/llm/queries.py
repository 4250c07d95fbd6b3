"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import (embedding_dedup, html_text, line_dedup, mixing, negatives, phrases, quality_rules, repeats, secrets, sentencepieces,
               simhash, token_counts, token_files)

QUERIES = {
    "op1_token_files": token_files.query,
    "op2_sentencepiece": sentencepieces.query,
    "op3_line_dedup": line_dedup.query,
    "op4_secret_scan": secrets.query,
    "op5_mix_sources": mixing.query,
    "op6_simhash_near_dedup": simhash.query,
    "op7_token_counts": token_counts.query,
    "op8_embedding_near_dedup": embedding_dedup.query,
    "op9_repeated_strings": repeats.query,
    "op10_quality_rules": quality_rules.query,
    "op11_hard_negatives": negatives.query,
    "op12_main_text": html_text.query,
    "op13_phrases": phrases.query,
}

ORACLES = {
    "op5_mix_sources": mixing.ORACLE_SQL,
    "op11_hard_negatives": negatives.ORACLE_SQL,
    "op13_phrases": phrases.ORACLE_SQL,
}
