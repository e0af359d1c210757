"""The registered queries, grouped by theme."""

from __future__ import annotations

from importlib import import_module

from lakeworks.queries.registry import ORACLES, QUERIES

THEMES = (
    "columns", "joins", "aggregates", "windows", "scans", "writes", "quality", "daily", "functions",
)


def load():
    """Import every theme; returns (queries, oracle SQL)."""
    for theme in THEMES:
        import_module(f"lakeworks.queries.{theme}")
    return QUERIES, ORACLES
