"""Analytical queries over the driver's tables, and their DuckDB SQL.

The tables stand for an archive of rankings: a provider is an order priority, an entity a
customer, a country a nation, an edition an order year, a score a sum of prices, a subject
a brand.
"""

from __future__ import annotations

from podium.plans import cells, documents, facts, ingest, merges, rankings, registries, scans, structure, tables

MODULES = (rankings, tables, facts, documents, merges, ingest, cells, registries, structure, scans)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
