"""Queries of the corpus operators and their DuckDB SQL, where SQL expresses them."""

from __future__ import annotations

from quillstone.llm.bpe import op8_bpe_merge_replay
from quillstone.llm.decontam import op7_greedy_string_tiling
from quillstone.llm.knn import OP9_SQL, op9_kd_tree_top_k
from quillstone.llm.langid import op1_viterbi_language_spans
from quillstone.llm.linededup import OP2_SQL, op2_cross_site_line_dedup
from quillstone.llm.quality import op4_ftrl_quality
from quillstone.llm.sharding import op3_feistel_sharding
from quillstone.llm.simhash import op10_simhash_near_dedup
from quillstone.llm.substrings import op5_suffix_array_dedup
from quillstone.llm.tokenfiles import op6_seekable_token_files

QUERIES = {
    f.__name__: f
    for f in (
        op1_viterbi_language_spans, op2_cross_site_line_dedup, op3_feistel_sharding, op4_ftrl_quality, op5_suffix_array_dedup,
        op6_seekable_token_files, op7_greedy_string_tiling, op8_bpe_merge_replay, op9_kd_tree_top_k, op10_simhash_near_dedup,
    )
}
ORACLES = {"op2_cross_site_line_dedup": OP2_SQL, "op9_kd_tree_top_k": OP9_SQL}
