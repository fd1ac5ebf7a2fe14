"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from trendcast.llm import (
    ann_search,
    chat_format,
    conversation_repair,
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    secret_scan,
    source_mixing,
    spelling_variants,
)
from trendcast.llm.common import Query

QUERIES: dict[str, Query] = {
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_language_id": language_id.op9_language_id,
    "op7_harmonic_packing": packing.op7_harmonic_packing,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_chat_format": chat_format.op5_chat_format,
    "op10_source_mixing": source_mixing.op10_source_mixing,
    "op6_license_scan": license_scan.op6_license_scan,
    "op3_ann_search": ann_search.op3_ann_search,
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_spelling_variants": spelling_variants.op12_spelling_variants,
    "op13_embedding_dedup": embedding_dedup.op13_embedding_dedup,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": ngram_join.ORACLE_SQL,
    "op5_chat_format": chat_format.ORACLE_SQL,
    "op13_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op8_exact_dedup": exact_dedup.ORACLE_SQL,
}
