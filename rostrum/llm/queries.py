"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import jaccard_join, language, lines, masked_lm, matroska, mixing, negatives, pieces, quality, sharding, token_counts, toxicity, whitening

MODULES = [mixing, jaccard_join, matroska, masked_lm, lines, toxicity, pieces, sharding, token_counts, quality, whitening, negatives, language]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
