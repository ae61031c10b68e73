"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under a name, with its SQL where SQL can say it."""

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = (fn, sql)
        return fn

    return wrap


def sql_of(name: str) -> str | None:
    """The SQL of a query registered before, for another plan of the same result."""
    return REGISTRY[name][1]
