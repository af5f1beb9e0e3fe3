"""The corpus queries by name, and their expected results where SQL can express them."""

from __future__ import annotations

from tributary.llm import (
    bpe_codec,
    centroid_clustering,
    conversation_repair,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    url_filters,
    vector_index,
    warc_archive,
)

LLM_QUERIES = {
    "op1_pii": pii.query,
    "op2_ngram_join": ngram_join.query,
    "op3_vector_index": vector_index.query,
    "op4_packing": packing.query,
    "op5_quality_classifier": quality_classifier.query,
    "op6_quality_rules": quality_rules.query,
    "op7_bpe_codec": bpe_codec.query,
    "op8_line_dedup": line_dedup.query,
    "op9_url_filters": url_filters.query,
    "op10_warc_archive": warc_archive.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_language_id": language_id.query,
    "op13_centroid_clustering": centroid_clustering.query,
}

LLM_ORACLE = {
    "op6_quality_rules": quality_rules.ORACLE_SQL,
    "op8_line_dedup": line_dedup.ORACLE_SQL,
    "op9_url_filters": url_filters.ORACLE_SQL,
    "op10_warc_archive": warc_archive.ORACLE_SQL,
    "op11_conversation_repair": conversation_repair.ORACLE_SQL,
    "op13_centroid_clustering": centroid_clustering.ORACLE_SQL,
}
