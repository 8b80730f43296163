"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloop.llm import (
    ann_tree,
    bpe,
    collocations,
    context_mixing,
    huffman,
    line_dedup,
    mixing,
    quality,
    quality_kernel,
    simhash,
    spelling,
    substrings,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": bpe.op1_bpe,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_ann_tree": ann_tree.op4_ann_tree,
    "op5_simhash": simhash.op5_simhash,
    "op6_huffman": huffman.op6_huffman,
    "op7_substrings": substrings.op7_substrings,
    "op8_context_mixing": context_mixing.op8_context_mixing,
    "op9_mixing": mixing.op9_mixing,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_quality_kernel": quality_kernel.op11_quality_kernel,
    "op12_spelling": spelling.op12_spelling,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op7_substrings": substrings.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
