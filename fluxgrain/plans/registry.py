"""Registered queries: name -> callable(spark, sf_dir) and, where SQL can say the same, name -> DuckDB SQL."""

from __future__ import annotations

from fluxgrain.plans import checks, derived, items, messages, more, rollups, streams, tables

QUERIES: dict = {}
ORACLES: dict = {}
for module in (rollups, checks, messages, tables, more, items, streams, derived):
    QUERIES.update(module.QUERIES)
    ORACLES.update(module.ORACLES)
FLAGSHIP = "rollup_1d_local"
