"""The registered queries opN_<name> and their DuckDB twins, from the modules beside this one."""

from __future__ import annotations

from innkeep.llm import q_ann, q_archives, q_language, q_licenses, q_manifest, q_mixing, q_neardup, q_packing, q_repair, q_search, q_sharding, q_suffixes, q_urls

MODULES = (q_archives, q_language, q_mixing, q_ann, q_packing, q_sharding, q_urls, q_search, q_neardup, q_licenses, q_suffixes, q_repair, q_manifest)

QUERIES: dict = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE: dict = {k: s for m in MODULES for k, s in m.ORACLE.items()}
