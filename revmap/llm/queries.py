"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from revmap.llm import (
    byte_bpe,
    code_compression,
    collocations,
    decontamination,
    kd_sharding,
    minhash_dedup,
    quality,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    voronoi_topk,
)

_MODULES = (
    decontamination,
    kd_sharding,
    byte_bpe,
    toxicity,
    quality,
    voronoi_topk,
    token_counts,
    minhash_dedup,
    suffix_dedup,
    substring_dedup,
    collocations,
    token_files,
    code_compression,
)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
