"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add
