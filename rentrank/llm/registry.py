"""The subpackage's queries, and SQL for those that SQL can express."""

from __future__ import annotations

from rentrank.llm import chat_format, collocations, decontamination, merkle_manifest, token_rollup, url_filter
from rentrank.llm.chat_format import op5_perspective_rotation
from rentrank.llm.collocations import op13_phrase_collocations
from rentrank.llm.decontamination import op6_benchmark_decontamination
from rentrank.llm.language_model import op2_log_bilinear_scoring
from rentrank.llm.merkle_manifest import op11_merkle_manifest
from rentrank.llm.packing import op9_packing
from rentrank.llm.sharding import op4_feistel_sharding
from rentrank.llm.simhash import op10_simhash_near_dedup
from rentrank.llm.suffix_dedup import op12_suffix_array_dedup
from rentrank.llm.token_rollup import op7_token_rollup
from rentrank.llm.toxicity import op1_kneser_ney_toxicity
from rentrank.llm.url_filter import op3_url_filter
from rentrank.llm.weighted_sampling import op8_weighted_sampling

QUERIES = {
    "op1_kneser_ney_toxicity": op1_kneser_ney_toxicity,
    "op2_log_bilinear_scoring": op2_log_bilinear_scoring,
    "op3_url_filter": op3_url_filter,
    "op4_feistel_sharding": op4_feistel_sharding,
    "op5_perspective_rotation": op5_perspective_rotation,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_token_rollup": op7_token_rollup,
    "op8_weighted_sampling": op8_weighted_sampling,
    "op9_packing": op9_packing,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_suffix_array_dedup": op12_suffix_array_dedup,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op3_url_filter": url_filter.ORACLE,
    "op5_perspective_rotation": chat_format.ORACLE,
    "op6_benchmark_decontamination": decontamination.ORACLE,
    "op7_token_rollup": token_rollup.ORACLE,
    "op11_merkle_manifest": merkle_manifest.ORACLE,
    "op13_phrase_collocations": collocations.ORACLE,
}
