"""All queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import op01_benchmark, op02_urls, op03_lines, op04_licenses, op05_shards, op06_media, op07_jaccard, op08_language, op09_toxicity, op10_pieces, op11_runs, op12_phrases, op13_mixing

MODULES = (op01_benchmark, op02_urls, op03_lines, op04_licenses, op05_shards, op06_media, op07_jaccard, op08_language, op09_toxicity, op10_pieces, op11_runs, op12_phrases, op13_mixing)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: q for m in MODULES for k, q in m.ORACLES.items()}
