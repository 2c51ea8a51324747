"""The registered queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from textquarry.llm import chat, decontamination, exact, licenses, lines, mixing, periods, quality, simhash, substrings, suffixes, tokens, whitening

QUERIES = {
    "op1_quality_classifier": quality.query,
    "op2_license_scans": licenses.query,
    "op3_substring_dedup": substrings.query,
    "op4_simhash_near_dedup": simhash.query,
    "op5_suffix_dedup": suffixes.query,
    "op6_decontamination": decontamination.query,
    "op7_exact_dedup": exact.query,
    "op8_line_dedup": lines.query,
    "op9_chat_formatting": chat.query,
    "op10_source_mixing": mixing.query,
    "op11_token_counts": tokens.query,
    "op12_embedding_whitening": whitening.query,
    "op13_periodic_runs": periods.query,
}

ORACLE = {
    "op2_license_scans": licenses.SQL,
    "op3_substring_dedup": substrings.SQL,
    "op5_suffix_dedup": suffixes.SQL,
    "op6_decontamination": decontamination.SQL,
    "op7_exact_dedup": exact.SQL,
    "op9_chat_formatting": chat.SQL,
}
