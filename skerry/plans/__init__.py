"""Registered queries over the supplied tables, each with its SQL statement where SQL can say it."""

from __future__ import annotations

from importlib import import_module

from skerry.plans.registry import REGISTRY, Query

MODULES = ["rows", "joins", "aggregates", "windows", "scalars", "quality", "warehouse", "scans", "streams"]


def load_all() -> dict[str, Query]:
    """Import every query module and return the registry."""
    for module in MODULES:
        import_module(f"skerry.plans.{module}")
    return REGISTRY
