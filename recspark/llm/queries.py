"""All queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from . import (alignment, chosen_path, decontaminate, hard_negatives, license_scan, line_dedup, packing, prefix_hash,
               quality, secret_scan, substring, token_orc, warc)

QUERIES: dict = {}
SQL: dict = {}
for _mod in (warc, decontaminate, quality, line_dedup, packing, token_orc, license_scan, secret_scan, substring, chosen_path,
             alignment, hard_negatives, prefix_hash):
    QUERIES.update(_mod.QUERIES)
    SQL.update(_mod.SQL)
