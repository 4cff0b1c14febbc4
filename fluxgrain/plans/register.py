"""How modules of queries collect them."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    queries: dict = {}
    oracles: dict = {}

    def query(name: str, sql: str | None = None) -> Callable:
        def add(f: Callable) -> Callable:
            queries[name] = f
            if sql is not None:
                oracles[name] = sql
            return f

        return add

    return queries, oracles, query
