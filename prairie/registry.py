"""All queries of the library and their SQL twins, gathered from the modules of ``plans``."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scalars", "relational", "revenue", "vectors", "graph", "models")


def _gather(what: str) -> dict:
    found: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"prairie.plans.{name}"), what)
        if twice := found.keys() & part.keys():
            raise ValueError(f"registered twice: {sorted(twice)}")
        found |= part
    return found


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("SQL")
