"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from asofworks.llm.bloom_lm import op2_bloom_lm
from asofworks.llm.lines import op1_line_dedup
from asofworks.llm.minhash import op9_minhash_forest
from asofworks.llm.mixing import op8_pareto_mix
from asofworks.llm.pieces import op6_merge_dropout
from asofworks.llm.quality import op5_byte_cnn
from asofworks.llm.sharding import op7_stratified_shards
from asofworks.llm.spelling import OP13_SQL, op13_spelling_variants
from asofworks.llm.token_files import op10_simple8b_tokens
from asofworks.llm.vectors import op3_adaptive_scan, op4_segment_topk
from asofworks.llm.whitening import op11_embedding_whitening
from asofworks.llm.word_bpe import op12_tree_bpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_bloom_lm": op2_bloom_lm,
    "op3_adaptive_scan": op3_adaptive_scan,
    "op4_segment_topk": op4_segment_topk,
    "op5_byte_cnn": op5_byte_cnn,
    "op6_merge_dropout": op6_merge_dropout,
    "op7_stratified_shards": op7_stratified_shards,
    "op8_pareto_mix": op8_pareto_mix,
    "op9_minhash_forest": op9_minhash_forest,
    "op10_simple8b_tokens": op10_simple8b_tokens,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_tree_bpe": op12_tree_bpe,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {"op13_spelling_variants": OP13_SQL}
