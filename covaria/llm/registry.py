"""Named queries of this subpackage."""

from __future__ import annotations

import importlib

from ..plans.registry import Query, Run

QUERIES: dict[str, Query] = {}

MODULES = ("warc", "extract", "token_cache", "toxicity", "simhash", "vectors", "decontaminate", "language", "packing", "templates", "quality", "manifest", "phrases")


def query(name: str, sql: str | None = None):
    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def load() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")
    return QUERIES
