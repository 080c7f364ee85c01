"""The registered queries of this subpackage and their SQL, in the operators' modules."""

from __future__ import annotations

from packhorse.llm import (
    conversations,
    cover_tree,
    html_text,
    jaccard_join,
    language_id,
    packing,
    pieces,
    quality_model,
    quality_rules,
    ranked_search,
    secrets,
    sharding,
    substrings,
)
from packhorse.llm.common import Query

MODULES = (
    packing, html_text, secrets, cover_tree, jaccard_join, quality_model, quality_rules, pieces, sharding, language_id,
    conversations, substrings, ranked_search,
)
QUERIES: dict[str, Query] = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
