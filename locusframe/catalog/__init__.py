"""Registered queries: each operator on data derived from the supplied tables, with its SQL twin."""

from __future__ import annotations

import importlib.util

MODULES = (
    "views",
    "interval_queries",
    "source_queries",
    "read_queries",
    "variant_queries",
    "trace_queries",
    "lineage_queries",
    "text_queries",
    "job_queries",
    "composite_queries",
)


def load() -> None:
    """Import every catalog module so its queries register."""
    for name in MODULES:
        if importlib.util.find_spec(f"{__name__}.{name}") is None:
            continue
        importlib.import_module(f"{__name__}.{name}")
