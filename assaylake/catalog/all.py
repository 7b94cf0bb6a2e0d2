"""All catalog queries by name."""

from __future__ import annotations

from importlib import import_module

MODULES = ("rules", "engine", "layers", "audit", "reports", "package", "lake")

QUERIES = {}
for _module in MODULES:
    QUERIES.update(import_module(f"assaylake.catalog.{_module}").QUERIES)
