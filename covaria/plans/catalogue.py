"""All registered queries."""

from __future__ import annotations

import importlib

from .registry import QUERIES, Query

for _module in ("table_queries", "raster_queries", "model_queries", "fit_queries"):
    importlib.import_module(f"{__package__}.{_module}")

__all__ = ["QUERIES", "Query"]
