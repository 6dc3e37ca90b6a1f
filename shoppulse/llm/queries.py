"""Registered queries of the text operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    arc_to_warc,
    best_fit_packing,
    chunk_bpe,
    conversation_trie,
    filter_audit,
    grouped_prefix_join,
    kernel_langid,
    multiprobe_lsh,
    quality_qda,
    quality_rules,
    subword_toxicity,
    suffix_tree_dedup,
    token_files,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kernel_langid": kernel_langid.query,
    "op2_suffix_tree_dedup": suffix_tree_dedup.query,
    "op3_subword_toxicity": subword_toxicity.query,
    "op4_byte_bpe": chunk_bpe.query,
    "op5_arc_to_warc": arc_to_warc.query,
    "op6_grouped_prefix_join": grouped_prefix_join.query,
    "op7_quality_rules": quality_rules.query,
    "op8_best_fit_packing": best_fit_packing.query,
    "op9_quality_qda": quality_qda.query,
    "op10_multiprobe_lsh": multiprobe_lsh.query,
    "op11_conversation_trie": conversation_trie.query,
    "op12_token_files": token_files.query,
    "op13_filter_audit": filter_audit.query,
}

SQL: dict[str, str] = {
    "op2_suffix_tree_dedup": suffix_tree_dedup.SQL,
    "op5_arc_to_warc": arc_to_warc.SQL,
    "op6_grouped_prefix_join": grouped_prefix_join.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op11_conversation_trie": conversation_trie.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
