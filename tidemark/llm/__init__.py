"""Operators for large-scale training-data pipelines, with their queries and the SQL they are checked against."""

from tidemark.llm.registry import ORACLES, QUERIES
from tidemark.llm import (  # noqa: F401
    decontamination,
    filter_audit,
    infill,
    jaccard_join,
    lm_scoring,
    packing,
    quality_neighbors,
    quality_rules,
    quotation,
    sharding,
    suffix_dedup,
    toxicity,
    url_filters,
)

__all__ = ["ORACLES", "QUERIES"]
