"""All registered queries."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "sampling", "features", "relational", "aggregation", "windows", "columns", "storage", "merging", "companies", "profiles", "checks", "texts", "kpis", "streams", "vectors", "chunks",
)


def all_catalogs():
    return [import_module(f"{__name__}.{m}").catalog for m in MODULES]
