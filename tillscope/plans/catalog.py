"""All registered queries: name -> (Spark query, comparison SQL or None)."""

from __future__ import annotations

from importlib import import_module

MODULES = ("catalog_customers", "catalog_transactions", "catalog_cleaning", "catalog_metrics", "catalog_segments", "catalog_models", "catalog_checks")


def registered() -> dict[str, tuple]:
    found: dict[str, tuple] = {}
    for module in MODULES:
        for name, entry in import_module(f"tillscope.plans.{module}").QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found
