"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from . import brown_lm, chat_format, decontaminate, hnsw_dedup, licenses, manifest, merkle, mixing, ngram_join, periodic_runs, quality_mil, secret_scan, sharding

MODULES = (merkle, ngram_join, quality_mil, decontaminate, sharding, mixing, licenses, chat_format, secret_scan, brown_lm, periodic_runs, manifest, hnsw_dedup)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
