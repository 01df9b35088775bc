"""Queries over the standard tables, each with its SQL twin where one exists."""

from importlib import import_module

from casework.plans.registry import REGISTRY, runnable

for _module in ("corpus", "search", "measures", "relations", "learning", "storage", "streams"):
    import_module(f"casework.plans.{_module}")


def queries():
    return {name: runnable(entry) for name, entry in REGISTRY.items()}


def oracle_sql():
    return {name: entry.sql for name, entry in REGISTRY.items() if entry.sql}
