"""All registered queries and their oracle SQL, merged from the families."""

from __future__ import annotations

import importlib

_FAMILIES = ["prep_queries", "eval_queries", "text_queries", "model_queries", "catalog_queries", "file_queries"]

QUERIES: dict = {}
SQL: dict = {}
for _name in _FAMILIES:
    _mod = importlib.import_module(f"{__package__}.{_name}")
    QUERIES.update(_mod.QUERIES)
    SQL.update(_mod.SQL)

FLAGSHIP = "item_histogram"
