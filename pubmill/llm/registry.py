"""The queries of this subpackage and their SQL, for the repository's entry point."""

from __future__ import annotations

import corpus_pipeline

from . import op3_tiered_shards, op9_hash_thresholds
from .op1_multi_index_hashing import op1_multi_index_hashing
from .op2_language_evidence import op2_language_evidence
from .op3_tiered_shards import op3_tiered_shards as op3
from .op4_baseline_jpeg import op4_baseline_jpeg
from .op5_prefix_tree_join import op5_prefix_tree_join
from .op6_licence_sentences import op6_licence_sentences
from .op7_personal_data import op7_personal_data
from .op8_forced_boundaries import op8_forced_boundaries
from .op9_hash_thresholds import op9_hash_thresholds as op9
from .op10_count_min_windows import op10_count_min_windows
from .op11_jacobi_whitening import op11_jacobi_whitening
from .op12_heap_lloyd import op12_heap_lloyd
from .op13_bin_completion import op13_bin_completion

QUERIES = {
    "op1_multi_index_hashing": op1_multi_index_hashing,
    "op2_language_evidence": op2_language_evidence,
    "op3_tiered_shards": op3,
    "op4_baseline_jpeg": op4_baseline_jpeg,
    "op5_prefix_tree_join": op5_prefix_tree_join,
    "op6_licence_sentences": op6_licence_sentences,
    "op7_personal_data": op7_personal_data,
    "op8_forced_boundaries": op8_forced_boundaries,
    "op9_hash_thresholds": op9,
    "op10_count_min_windows": op10_count_min_windows,
    "op11_jacobi_whitening": op11_jacobi_whitening,
    "op12_heap_lloyd": op12_heap_lloyd,
    "op13_bin_completion": op13_bin_completion,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op3_tiered_shards": op3_tiered_shards.SQL,
    "op9_hash_thresholds": op9_hash_thresholds.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
