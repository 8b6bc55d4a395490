"""Registered queries: a callable per name and, where SQL can say it, its SQL text."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Register the decorated function under its name."""
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add
