"""The runnable queries, one module per family."""

from __future__ import annotations

import importlib

from tallyloom.plans.registry import REGISTRY, Query, Tables

FAMILIES = (
    "sources",
    "profiling",
    "projections",
    "filters",
    "joins",
    "aggregations",
    "reshaping",
    "windows",
    "sorting",
    "set_ops",
    "strings",
    "calendar",
    "collections",
    "maintenance",
    "streams",
    "functions_api",
    "corpus",
)


def load_all() -> dict[str, Query]:
    for family in FAMILIES:
        importlib.import_module(f"tallyloom.plans.{family}")
    return REGISTRY


__all__ = ["FAMILIES", "Query", "Tables", "load_all"]
