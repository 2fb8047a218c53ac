"""The queries of this subpackage: importing a module adds its queries."""

from __future__ import annotations

from graphloom.llm import (  # noqa: F401
    bpe_trie,
    centroids,
    decontaminate,
    hard_negatives,
    language_id,
    line_dedup,
    packing,
    personal_data,
    secret_scan,
    shingle_join,
    token_counts,
    url_filter,
    vector_search,
)
from graphloom.llm.common import QUERIES  # noqa: F401
