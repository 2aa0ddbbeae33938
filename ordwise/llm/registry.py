"""Queries of this subpackage and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

from ordwise.llm import (
    html_region,
    lang_id,
    merkle,
    minhash_forest,
    mixing,
    ngram_trie,
    packing,
    quality_rules,
    spot_sigs,
    suffix_dedup,
    vector_graph,
    vector_means,
    warc_revisit,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.q_suffix_dedup,
    "op2_quality_rules": quality_rules.q_quality_rules,
    "op3_html_region": html_region.q_html_region,
    "op4_lang_id": lang_id.q_lang_id,
    "op5_warc_revisit": warc_revisit.q_warc_revisit,
    "op6_ngram_trie": ngram_trie.q_ngram_trie,
    "op7_vector_graph": vector_graph.q_vector_graph,
    "op8_mixing": mixing.q_mixing,
    "op9_packing": packing.q_packing,
    "op10_minhash_forest": minhash_forest.q_minhash_forest,
    "op11_spot_sigs": spot_sigs.q_spot_sigs,
    "op12_merkle_manifest": merkle.q_merkle_manifest,
    "op13_vector_means": vector_means.q_vector_means,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality_rules.ORACLE_SQL,
    "op5_warc_revisit": warc_revisit.ORACLE_SQL,
    "op7_vector_graph": vector_graph.ORACLE_SQL,
    "op10_minhash_forest": minhash_forest.ORACLE_SQL,
    "op11_spot_sigs": spot_sigs.ORACLE_SQL,
    "op12_merkle_manifest": merkle.ORACLE_SQL,
    "op13_vector_means": vector_means.ORACLE_SQL,
}
