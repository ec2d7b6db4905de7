"""All queries of this subpackage; importing it registers them."""

from nearfield.llm import (  # noqa: F401
    conversation_repair,
    cotraining,
    duck_bpe,
    fingerprints,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    periodic_runs,
    quality_rules,
    secret_scan,
    token_count,
    token_files,
)
from nearfield.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
