"""The corpus queries and the oracle SQL of those that SQL can express."""

from __future__ import annotations

from logweave.llm import (
    decontaminate, exact_dedup, html_extract, jaccard_join, language, licenses, line_dedup, merkle, mixing, periodic_runs, quality_rules, secrets, substring_dedup,
)

_MODULES = (
    decontaminate, exact_dedup, html_extract, jaccard_join, language, licenses, line_dedup, merkle, mixing, periodic_runs, quality_rules, secrets, substring_dedup,
)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
