"""Queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from rowloom.plans import files, generation, metadata, rollups, slicing

MODULES = (rollups, generation, files, slicing, metadata)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
