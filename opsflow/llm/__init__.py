"""Operators of a training-data pipeline and their registered queries."""

from opsflow.llm import (  # noqa: F401
    ball_tree_search,
    exact_dedup,
    language_id,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    sharding,
    suffix_dedup,
    tensor_minhash,
    threshold_join,
    token_counts,
    url_filters,
)
from opsflow.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
