"""Queries of the operators for training text, and their SQL twins."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "secrets", "chat", "hmm", "packing", "lines", "decontaminate", "jaccard", "toxicity", "binary", "quality",
    "trie", "search", "simhash",
)


def _gather(what: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(import_module(f"prairie.llm.{name}"), what)
    return found


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("SQL")
