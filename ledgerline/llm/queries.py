"""The corpus queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import anchors, bpe_tree, burst_trie, cover_tree, fingerprints, html_text, hyperlang, link_trust, minmax_dedup, mixing, packing, toxicity, walsh_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_template_text": html_text.query,
    "op2_oph_fingerprints": fingerprints.query,
    "op3_dual_tree_top_k": cover_tree.query,
    "op4_anchor_pii": anchors.query,
    "op5_hyperdimensional_language": hyperlang.query,
    "op6_bidirectional_gru_toxicity": toxicity.query,
    "op7_min_max_dedup": minmax_dedup.query,
    "op8_low_discrepancy_mix": mixing.query,
    "op9_certified_packing": packing.query,
    "op10_link_trust": link_trust.query,
    "op11_tree_bpe": bpe_tree.query,
    "op12_walsh_codes": walsh_codes.query,
    "op13_burst_trie": burst_trie.query,
}

ORACLE_SQL: dict[str, str] = {
    "op3_dual_tree_top_k": cover_tree.ORACLE,
    "op8_low_discrepancy_mix": mixing.ORACLE,
    "op10_link_trust": link_trust.oracle(),
    "op12_walsh_codes": walsh_codes.ORACLE,
    "op13_burst_trie": burst_trie.ORACLE,
}
