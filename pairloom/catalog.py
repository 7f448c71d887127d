"""All registered queries of the engine and their SQL twins."""

from __future__ import annotations

from pairloom.plans import alignment_queries, entity_queries, format_queries, host_queries, pair_queries, registry, structure_queries  # noqa: F401 - registers its queries

QUERIES, ORACLE_SQL = registry.QUERIES, registry.SQL
FLAGSHIP = "pair_dedup_tiered"
