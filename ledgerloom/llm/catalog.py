"""The corpus operators' queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_convolution,
    compression_bands,
    group_matrix,
    language_families,
    merkle,
    mixing,
    periodic_runs,
    pii,
    pruned_graph,
    sentencepieces,
    sharding,
    token_files,
    url_filter,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_host_words": url_filter.op1_host_words,
        "op2_group_matrix": group_matrix.op2_group_matrix,
        "op3_disclosure": pii.op3_disclosure,
        "op4_byte_convolution": byte_convolution.op4_byte_convolution,
        "op5_stratified_interleaving": sharding.op5_stratified_interleaving,
        "op6_weighted_mix": mixing.op6_weighted_mix,
        "op7_compression_bands": compression_bands.op7_compression_bands,
        "op8_context_mixing": token_files.op8_context_mixing,
        "op9_pruned_graph": pruned_graph.op9_pruned_graph,
        "op10_sentencepiece": sentencepieces.op10_sentencepiece,
        "op11_checkpoint_manifest": merkle.op11_checkpoint_manifest,
        "op12_language_families": language_families.op12_language_families,
        "op13_maximal_pairs": periodic_runs.op13_maximal_pairs,
    }


def oracles() -> dict[str, str]:
    return {"op5_stratified_interleaving": sharding.ORACLE, "op6_weighted_mix": mixing.ORACLE, "op11_checkpoint_manifest": merkle.ORACLE}
