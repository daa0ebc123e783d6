"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from glyphvec.llm import (
    clusters, jaccard, langid, mixing, packing, pii, quality, secretscan, sentencepieces, spelling, topk, toxicity,
    urlfilter,
)

_MODULES = (
    toxicity, urlfilter, secretscan, sentencepieces, quality, pii, packing, jaccard, langid, topk, clusters, spelling,
    mixing,
)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in getattr(module, "SQL", {}).items()}
